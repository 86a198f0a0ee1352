"""Site lookups: a cascade of fallback keys in one pass, coordinates from two sources, the nearest site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.functions.numbers import haversine_km
from rosterloom.functions.text import school_code, without_district
from rosterloom.operators.dedup import keep_first
from rosterloom.sources.shared import written

#: Dimensions of up to so many rows are broadcast; larger ones are left to the planner.
SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df, with a broadcast hint if it has `most` rows or fewer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def code_map(site_codes: DataFrame) -> DataFrame:
    """code -> mesa of raw codes (escuela_raw, mesa, ord), the first of a code."""
    return keep_first(site_codes.select(school_code(F.col("escuela_raw")).alias("code"), "mesa", "ord"), ["code"], "ord").select("code", "mesa")


def assign_sites(roster: DataFrame, site_codes: DataFrame) -> DataFrame:
    """roster with code, mesa and which key matched (0 none, 1 exact, 2 JI- as J1- in the map, 3 M3-/M5-/M8- as MS- in the roll).

    One pass over the codes gives one map of unique keys, with a number for a code as it is and one for it repaired; the
    roll looks up its code, and as MS- if that differs. The first hit wins and no row is multiplied.
    """
    first = site_codes.groupBy(school_code(F.col("escuela_raw")).alias("code")).agg(F.min_by("mesa", "ord").alias("mesa"), F.min("ord").alias("ord"))
    both = first.select(F.explode(F.array(F.struct("code", F.lit(False).alias("repaired"), "mesa", "ord"), F.struct(F.regexp_replace("code", "^JI-", "J1-").alias("code"), F.lit(True).alias("repaired"), "mesa", "ord"))).alias("x")).select("x.*")
    exact, repaired = F.when(~F.col("repaired"), F.col("mesa")), F.when(F.col("repaired"), F.col("mesa"))
    codes = small(both.groupBy("code").agg(F.max(exact).alias("_m1"), F.min_by(repaired, F.when(F.col("repaired"), F.col("ord"))).alias("_m2")))
    x = roster.withColumn("code", without_district(F.col("escuela"))).withColumn("_third", F.regexp_replace("code", "^M[358]-", "MS-"))
    x = x.join(codes.withColumnRenamed("code", "_k1"), F.col("code") == F.col("_k1"), "left")
    third = codes.select(F.col("code").alias("_k3"), F.col("_m1").alias("_m3"))
    x = x.join(third, F.when(F.col("_third") != F.col("code"), F.col("_third")) == F.col("_k3"), "left")
    hit = F.when(F.col("_m1").isNotNull(), 1).when(F.col("_m2").isNotNull(), 2).when(F.col("_m3").isNotNull(), 3).otherwise(0)
    return x.withColumn("mesa", F.coalesce("_m1", "_m2", "_m3")).withColumn("pass", hit.cast("bigint")).drop("_third", "_k1", "_k3", "_m1", "_m2", "_m3")


def with_sites(assigned: DataFrame, sites: DataFrame, own: str | None = None) -> DataFrame:
    """zona 0 and no name where no site is found; with `own`, mesa_sede: the site found, else the member's own number in that column."""
    s = small(sites.select(F.col("mesa").alias("_mesa"), "zona", "zona_nombre", "escuela_sede"))
    out = assigned.join(s, F.col("mesa") == F.col("_mesa"), "left").drop("_mesa").withColumn("zona", F.coalesce("zona", F.lit(0).cast("bigint")))
    return out.withColumn("mesa_sede", F.coalesce("mesa", own)) if own else out


def coords_fallback(entries: DataFrame, coords: DataFrame, geocoded: DataFrame) -> DataFrame:
    """lat and lng by the old number, else by the new label; blank or NaN coordinates count as none."""
    first = coords.where(F.col("lat").isNotNull() & ~F.isnan("lat")).select(F.col("mesa").alias("_a"), F.col("lat").alias("_lat1"), F.col("lng").alias("_lng1"))
    x = entries.join(small(first), F.col("mesa_2022") == F.col("_a"), "left")
    x = x.join(small(geocoded.select(F.col("label").alias("_b"), F.col("lat").alias("_lat2"), F.col("lng").alias("_lng2"))), F.col("mesa_2026") == F.col("_b"), "left")
    source = F.when(F.col("_lat1").isNotNull(), "old").when(F.col("_lat2").isNotNull(), "new").otherwise("none")
    out = x.withColumn("lat", F.coalesce("_lat1", "_lat2")).withColumn("lng", F.when(F.col("_lat1").isNotNull(), F.col("_lng1")).otherwise(F.col("_lng2"))).withColumn("source", source)
    return out.drop("_a", "_b", "_lat1", "_lat2", "_lng1", "_lng2")


#: A leaf holds so many sites at most, unless they are within LEVELS halvings (by eight) of one another.
LEAF, LEVELS, SPLIT = 64, 7, 8


def _on_sphere(df: DataFrame) -> DataFrame:
    """df (lat, lng) with x, y, z on the unit sphere: straight distances there rise with those on the ground, at the poles and across the date line, too."""
    lat, lng = F.radians("lat"), F.radians("lng")
    return df.withColumns({"x": F.cos(lat) * F.cos(lng), "y": F.cos(lat) * F.sin(lng), "z": F.sin(lat)})


def _cell(level: int) -> Column:
    """The cube of that level that (x, y, z) is in: 8^level to each side."""
    n = SPLIT**level
    at = lambda c: F.least(F.greatest(F.floor((F.col(c) + 1) / 2 * n), F.lit(0)), F.lit(n - 1))
    return (at("x") * n + at("y")) * n + at("z")


def _site_tree(sites: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of cubes around sites (ord, mesa, lat, lng): for each level from the top (cell, kids), and the leaves (cell, sites).

    A kid is a cube that holds a site, with the box around its sites and a site of it. The depth is the least at which no
    cube holds more than LEAF sites.
    """
    # of sites in one place only the first can be nearest
    distinct = _on_sphere(sites.groupBy("lat", "lng").agg(F.min(F.struct("ord", "mesa")).alias("_s")).where("lat IS NOT NULL AND lng IS NOT NULL").select("_s.ord", "_s.mesa", "lat", "lng"))
    placed = written(distinct.select("*", *(_cell(k).alias(f"c{k}") for k in range(LEVELS + 1))))
    counts = placed.select(F.posexplode(F.array(*(f"c{k}" for k in range(LEVELS + 1)))).alias("level", "cell")).groupBy("level", "cell").agg(F.count("*").alias("n"))
    fullest = dict(counts.groupBy("level").agg(F.max("n").alias("n")).collect())  # a row for each level
    depth = next((k for k in range(LEVELS) if fullest.get(k, 0) <= LEAF), LEVELS)
    levels = []
    for k in range(depth):
        box = [f(c).alias(f"{c}{i}") for c in "xyz" for i, f in enumerate((F.min, F.max))]
        kids = placed.groupBy(F.col(f"c{k}").alias("cell"), F.col(f"c{k + 1}").alias("kid")).agg(*box, F.min(F.struct("ord", "x", "y", "z")).alias("r"))
        levels.append(kids.groupBy("cell").agg(F.collect_list(F.struct("kid", *(f"{c}{i}" for c in "xyz" for i in (0, 1)), "r.x", "r.y", "r.z")).alias("kids")))
    leaves = placed.groupBy(F.col(f"c{depth}").alias("cell")).agg(F.collect_list(F.struct("ord", "mesa", "lat", "lng", "x", "y", "z")).alias("sites"))
    return levels, leaves


def _square(x: Column) -> Column:
    return x * x


def _km_to(site: Column) -> Column:
    """(km, ord, mesa) from the row's place to a site; null for a row without one."""
    km = haversine_km(F.col("lat"), F.col("lng"), site["lat"], site["lng"])
    return F.when(km.isNotNull(), F.struct(km.alias("km"), site["ord"].alias("ord"), site["mesa"].alias("mesa")))


def nearest_site(points: DataFrame, sites: DataFrame) -> DataFrame:
    """points (id, lat, lng) with the nearest site (mesa, ord) and its distance in km, the first (ord) of equals; a point without coordinates, and any if there is no site, has none.

    Each point first goes down the tree to the site that it seems nearest to, which bounds its distance; then again, to all
    cubes whose boxes are within that bound, a few. So a point meets some leaves, however many sites there are and however
    far off it is, and every level is a join on the cube. Sites that one leaf holds need no tree: they are one row.
    """
    if sites.limit(LEAF + 1).count() <= LEAF:
        all_ = sites.where("lat IS NOT NULL AND lng IS NOT NULL").agg(F.collect_list(F.struct("ord", "mesa", "lat", "lng")).alias("sites"))
        met = points.join(F.broadcast(all_)).select("id", "lat", "lng", F.array_min(F.transform("sites", _km_to)).alias("_near"))
        return met.select("id", "lat", "lng", F.col("_near.mesa").alias("mesa"), F.col("_near.km").alias("km"))
    levels, leaves = _site_tree(sites)
    levels, leaves = [small(x) for x in levels], small(leaves)
    # the top cube is read back as data: a literal would make a product of the join with it
    start = _on_sphere(points.select("id", "lat", "lng").withColumns({"_p": F.monotonically_increasing_id(), "_top": F.lit(0).cast("bigint")}))
    start = written(start).withColumn("cell", F.col("_top"))
    kid_ub = lambda k: _square(F.col("x") - k["x"]) + _square(F.col("y") - k["y"]) + _square(F.col("z") - k["z"])
    out_of = lambda k, c: F.greatest(F.lit(0.0), k[f"{c}0"] - F.col(c), F.col(c) - k[f"{c}1"])
    kid_lb = lambda k: sum((_square(out_of(k, c)) for c in "yz"), _square(out_of(k, "x")))

    bounded = start
    for level in levels:
        best = F.array_min(F.transform("kids", lambda k: F.struct(kid_ub(k).alias("d"), k["kid"].alias("kid"))))
        bounded = bounded.join(level, "cell", "left").withColumn("_best", best).drop("cell", "kids").withColumn("cell", F.col("_best.kid")).drop("_best")
    nearest = F.array_min(F.transform("sites", kid_ub))
    bounded = bounded.join(leaves, "cell", "left").withColumn("bound", nearest * (1 + 1e-9) + 1e-12).drop("cell", "sites")

    x = bounded.withColumn("cell", F.col("_top"))
    for level in levels:
        within = F.filter("kids", lambda k: kid_lb(k) <= F.col("bound"))
        x = x.join(level, "cell", "left").withColumn("cell", F.explode_outer(F.transform(within, lambda k: k["kid"]))).drop("kids")
    near = F.filter("sites", lambda s: kid_ub(s) <= F.col("bound"))
    found = F.array_min(F.transform(near, _km_to))
    met = x.join(leaves, "cell", "left").select("_p", "id", "lat", "lng", found.alias("_near"))
    if levels:  # without levels every point has met the one leaf
        met = met.groupBy("_p").agg(F.first("id").alias("id"), F.first("lat").alias("lat"), F.first("lng").alias("lng"), F.min("_near").alias("_near"))
    return met.select("id", "lat", "lng", F.col("_near.mesa").alias("mesa"), F.col("_near.km").alias("km"))


def fill_first_match(entries: DataFrame, updates: DataFrame, key: str, value: str) -> DataFrame:
    """`value` of the first entry (ord) of each key from the first non-blank update (ord) of that key, if it is blank; other entries stay."""
    new = keep_first(updates.where(F.coalesce(value, F.lit("")) != ""), [key], "ord").select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    first = entries.groupBy(key).agg(F.min("ord").alias("_first")).withColumnRenamed(key, "_fk")
    x = entries.join(first, F.col(key) == F.col("_fk"), "left").join(new, F.col(key) == F.col("_k"), "left")
    filled = F.when((F.col("ord") == F.col("_first")) & (F.coalesce(value, F.lit("")) == ""), F.coalesce("_v", value)).otherwise(F.col(value))
    return x.withColumn(value, filled).select(*entries.columns)
