"""The registered queries of the roll operators over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.functions.numbers import marker_size
from rosterloom.functions.text import has_junk, has_problem_note, map_url, name_key, names_match, same_places
from rosterloom.operators import compare, dedup, layout, lookup, parse, reconcile, search, summaries, tasks
from rosterloom.plans import views as v
from rosterloom.sources import readers
from rosterloom.sources.shared import shared_dir
from rosterloom.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def codes_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with their codes in arrays (mesa, codes), a site's in as many as keep each one short."""
    return lookup.code_map(v.site_codes(spark, sf_dir)).groupBy("mesa", F.pmod(F.xxhash64("code"), F.lit(256)).alias("_block")).agg(F.collect_list("code").alias("codes")).drop("_block")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.with_sites(lookup.assign_sites(v.roster_a(spark, sf_dir), v.site_codes(spark, sf_dir)), v.sites(spark, sf_dir))


# lookups and summaries


@query
def zone_summary(spark, sf_dir):
    return summaries.zone_summary(enriched(spark, sf_dir))


@query
def site_summary(spark, sf_dir):
    return summaries.site_summary(enriched(spark, sf_dir))


@query
def uncovered_codes(spark, sf_dir):
    return summaries.uncovered_codes(enriched(spark, sf_dir))


@query
def coverage(spark, sf_dir):
    return summaries.coverage(enriched(spark, sf_dir))


@query
def fallback_lookup(spark, sf_dir):
    """Codes damaged on either side: JI as J1, MS as M3, M5 or M8."""
    roll = v.roster_a(spark, sf_dir).withColumn("escuela", F.expr("CASE WHEN ord % 3 = 0 THEN replace(escuela, '-JI-', '-J1-') WHEN ord % 3 = 1 THEN replace(escuela, '-MS-', '-M5-') ELSE escuela END"))
    return lookup.with_sites(lookup.assign_sites(roll, v.site_codes(spark, sf_dir)), v.sites(spark, sf_dir)).select("ord", "code", "mesa", "pass", "zona")


@query
def code_type_counts(spark, sf_dir):
    return summaries.code_type_counts(v.roster_a(spark, sf_dir))


@query
def page_nested(spark, sf_dir):
    return summaries.nested_counts(summaries.page_nested(v.roster_a(spark, sf_dir)))


# lines to records


@query
def sanitize_lines(spark, sf_dir):
    return parse.sanitize_lines(v.ocr_lines(spark, sf_dir)).select("page", "pos", "cleaned")


@query
def parse_lines(spark, sf_dir):
    return parse.records(parse.parse_lines(v.ocr_lines(spark, sf_dir))).withColumn("confianza", F.round("confianza", 6))


@query
def carry_forward_context(spark, sf_dir):
    return parse.parse_lines(v.ocr_lines(spark, sf_dir)).select("page", "pos", "is_header", "carried")


@query
def rejected_lines(spark, sf_dir):
    return parse.rejects(parse.parse_lines(v.ocr_lines(spark, sf_dir)))


@query
def page_quality(spark, sf_dir):
    return parse.page_quality(parse.records(parse.parse_lines(v.ocr_lines(spark, sf_dir))))


# choosing rows


def _orders(spark, sf_dir):
    return v.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query
def dedup_keep_first(spark, sf_dir):
    return dedup.keep_first(_orders(spark, sf_dir), ["o_custkey"], "o_orderkey")


@query
def dedup_keep_last(spark, sf_dir):
    return dedup.keep_last(_orders(spark, sf_dir), ["o_custkey"], "o_orderkey")


@query
def duplicate_rows(spark, sf_dir):
    return dedup.duplicates(_orders(spark, sf_dir), ["o_custkey"], "o_orderkey")


@query
def best_variant(spark, sf_dir):
    x = v.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS grp", "CAST(l_linenumber AS BIGINT) AS ord", "'v' || CAST(l_linenumber AS STRING) AS path", "CAST(l_quantity AS BIGINT) % 5 AS con_dni", "CAST(l_quantity AS BIGINT) % 3 AS con_nombre", "CAST(l_quantity AS BIGINT) + 25 AS records")
    return tasks.best_variant(x)


@query
def sample_top_n(spark, sf_dir):
    """Three line items of each order, returned ones first, then open ones."""
    x = v.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_returnflag")
    kind = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return tasks.sample_top_n(x, "l_orderkey", [kind, F.col("l_linenumber")], 3)


@query
def batch_chunks(spark, sf_dir):
    """Whole orders in batches of 500 by key, and a batch's size, ends and sum of customers."""
    x = tasks.chunked(v.table(spark, sf_dir, "orders"), "o_orderkey")
    return x.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"), F.sum("o_custkey").alias("customers"), F.max("place").alias("last_place"))


# reconciling


@query
def reconcile_full_outer(spark, sf_dir):
    return reconcile.survive(v.roster_a(spark, sf_dir), v.roster_b(spark, sf_dir))


@query
def reconcile_stats(spark, sf_dir):
    return reconcile.survive_stats(reconcile.survive(v.roster_a(spark, sf_dir), v.roster_b(spark, sf_dir)))


@query
def key_set_diff(spark, sf_dir):
    return reconcile.key_diff(v.roster_a(spark, sf_dir), v.roster_b(spark, sf_dir), "dni")


@query
def history_correction(spark, sf_dir):
    x = reconcile.correct_by_history(reconcile.with_history(v.roster_a(spark, sf_dir), v.history(spark, sf_dir)), ratio=False)
    return x.select("ord", "nombre", "nombre_past", "accion", "nombre_final", "estado_escuela")


@query
def history_similarity(spark, sf_dir):
    x = reconcile.correct_by_history(reconcile.with_history(v.roster_a(spark, sf_dir), v.history(spark, sf_dir)))
    return x.select("ord", "nombre", "nombre_past", F.round("similitud", 6).alias("similitud"), "accion", "nombre_final")


@query
def engine_vote(spark, sf_dir):
    return reconcile.vote(v.engines(spark, sf_dir)).withColumn("confianza", F.round("confianza", 6))


@query
def hybrid_gate(spark, sf_dir):
    pages = v.engines(spark, sf_dir).where("engine_no = 1").groupBy(F.floor(F.col("ord") / 7.0).cast("bigint").alias("page")).agg(F.round(F.avg("confianza"), 6).alias("confianza"))
    return reconcile.hybrid_gate(pages)


@query
def hybrid_roll(spark, sf_dir):
    return reconcile.hybrid_roll(v.roster_a(spark, sf_dir), v.history(spark, sf_dir))


@query
def fuzzy_names(spark, sf_dir):
    a = v.roster_a(spark, sf_dir).where("dni <> ''").select("dni", F.col("nombre").alias("a"))
    b = v.roster_b(spark, sf_dir).where("dni <> ''").select("dni", F.col("nombre").alias("b"))
    keys = F.transform(F.array(F.struct(name_key(F.col("a")).alias("x"), name_key(F.col("b")).alias("y"))), lambda k: F.struct(k["y"].alias("key"), F.round(same_places(k["x"], k["y"]), 6).alias("share")))[0]
    return a.join(b, "dni").select("dni", keys.alias("k"), names_match(F.col("a"), F.col("b")).alias("same")).select("dni", "k.key", "k.share", "same")


@query
def schema_drift_union(spark, sf_dir):
    """Two files of one roll under different headers."""
    a = v.table(spark, sf_dir, "customer").selectExpr("'DNI' AS TIPO", "CAST(c_custkey AS STRING) AS DOCUMENTO", "c_name AS NOMBRE", "c_mktsegment AS ESCUELA")
    b = v.table(spark, sf_dir, "supplier").selectExpr("'LC' AS TIPO", "CAST(s_suppkey AS STRING) AS DNI", "s_name AS APELLIDO_NOMBRE", "'' AS ESCUELA", "'x' AS DESTINO", "'nota' AS OBSERVACION")
    return readers.union_variants(a, b)


@query
def problem_notes(spark, sf_dir):
    x = v.roster_b(spark, sf_dir)
    return x.select("ord", has_problem_note(F.col("observacion")).alias("problem"), has_junk(F.concat("nombre", F.expr("CASE WHEN ord % 8 = 0 THEN '|' ELSE '' END"))).alias("junk"))


# verification work


def _prioritised(spark, sf_dir):
    scanned = v.roster_b(spark, sf_dir).select(F.col("pagina").alias("page"), F.col("ord").alias("pos"), "dni", "nombre", "escuela")
    return tasks.priorities(scanned, v.roster_a(spark, sf_dir))


@query
def verification_priority(spark, sf_dir):
    return _prioritised(spark, sf_dir).select("page", "pos", "prioridad", "rank", F.array_join("diff", ",").alias("diff"))


@query
def task_summary(spark, sf_dir):
    return tasks.task_summary(_prioritised(spark, sf_dir))


@query
def task_histogram(spark, sf_dir):
    return tasks.priority_histogram(tasks.task_summary(_prioritised(spark, sf_dir)))


@query
def verified_export(spark, sf_dir):
    """Orders as tasks, customers' lines as records; orders with status F are done."""
    lines = v.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("task_id")).agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").cast("string").alias("dni")))).alias("records"))
    done = v.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("volunteer_id"))
    return tasks.verified_export(lines.join(done, "task_id"), lines)


# snapshots and search


def _snapshots(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer")
    old = c.selectExpr("c_custkey AS id", "'M' || CAST(c_nationkey AS STRING) AS mesa", "c_mktsegment AS nombre")
    new = c.selectExpr("CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 10000000 ELSE c_custkey END AS id", "'M' || CAST(CASE WHEN c_custkey % 4 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS STRING) AS mesa", "c_mktsegment AS nombre")
    return compare.snapshot_diff(old, new, "id", ["mesa", "nombre"])


@query
def snapshot_diff(spark, sf_dir):
    return _snapshots(spark, sf_dir)


@query
def snapshot_counts(spark, sf_dir):
    return compare.snapshot_counts(_snapshots(spark, sf_dir))


@query
def compare_filter(spark, sf_dir):
    return compare.compare_filter(_snapshots(spark, sf_dir), "mantiene", "M1", ["mesa_old", "mesa_new", "nombre_old", "nombre_new"]).select("id", "estado", "mesa_old", "mesa_new")


@query
def site_coords_fallback(spark, sf_dir):
    sites = v.sites(spark, sf_dir)
    entries = sites.selectExpr("mesa AS id", "CASE WHEN mesa % 3 = 0 THEN NULL ELSE mesa END AS mesa_2022", "'M' || CAST(mesa AS STRING) AS mesa_2026")
    coords = sites.selectExpr("mesa", "CASE WHEN mesa % 4 = 0 THEN NULL WHEN mesa % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE lat END AS lat", "lng")
    places = readers.lookup_table(spark, [(f"M{i}", -35.0 - i / 8, -59.0 - i / 16) for i in range(1, 16)], "label string, lat double, lng double")
    x = lookup.coords_fallback(entries, coords, places)
    return x.select("id", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "source", (map_url(F.col("lat"), F.col("lng")) != "-").alias("has_url"), map_url(F.round("lat", 0).cast("int"), F.round("lng", 0).cast("int")).alias("url"))


@query
def nearest_site(spark, sf_dir):
    points = v.table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "CAST(-34.55 AS DOUBLE) - (c_custkey % 101) * CAST(0.0041 AS DOUBLE) AS lat", "CAST(-58.45 AS DOUBLE) - (c_custkey % 89) * CAST(0.0037 AS DOUBLE) AS lng")
    return lookup.nearest_site(points, v.sites(spark, sf_dir).withColumn("ord", F.col("mesa"))).select("id", "mesa", F.round("km", 6).alias("km"))


@query
def zone_heat(spark, sf_dir):
    """Members of each site with the marker's size and the share of the largest."""
    x = enriched(spark, sf_dir).where("zona > 0").groupBy("mesa").agg(F.count("*").alias("votos"))
    most = x.agg(F.max("votos").alias("_most"))
    return x.join(F.broadcast(most)).select("mesa", "votos", marker_size(F.col("votos")).cast("bigint").alias("size"), F.round(F.col("votos") / F.col("_most"), 6).alias("share"))


@query
def search_id(spark, sf_dir):
    return search.search_id(v.roster_a(spark, sf_dir), "0012").select("ord", "dni", "nombre")


@query
def search_zone(spark, sf_dir):
    return search.search_zone(enriched(spark, sf_dir), v.sites(spark, sf_dir), "2 ")[1].select("ord", "dni", "zona")


@query
def search_site(spark, sf_dir):
    return search.search_site(enriched(spark, sf_dir), v.sites(spark, sf_dir), "n_1")[1].select("ord", "dni", "mesa")


@query
def search_code(spark, sf_dir):
    return search.search_code(enriched(spark, sf_dir), "ms 7").select("ord", "code", "mesa")


@query
def typeahead(spark, sf_dir):
    return search.typeahead(v.sites(spark, sf_dir).select("escuela_sede"), "escuela_sede", "1", 4)


@query
def distinct_codes(spark, sf_dir):
    return search.distinct_codes(codes_by_site(spark, sf_dir))


# layout


def _words(spark, sf_dir):
    return v.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS page", "CAST(l_linenumber AS BIGINT) AS ord", "CAST(l_quantity * 2 AS BIGINT) AS y")


@query
def word_rows(spark, sf_dir):
    return layout.word_rows(_words(spark, sf_dir))


@query
def line_islands(spark, sf_dir):
    x = v.table(spark, sf_dir, "events").selectExpr("CAST(user_id AS BIGINT) AS page", "CAST(event_id AS BIGINT) AS pos", "event_type AS line_num", "event_type AS text", "value AS conf", "CAST(event_id % 97 AS BIGINT) AS x", "CAST(event_id % 89 AS BIGINT) AS y", "CAST(10 AS BIGINT) AS w", "CAST(5 AS BIGINT) AS h")
    return layout.lines_of_words(x).withColumn("conf", F.round("conf", 6))


@query
def page_confidence(spark, sf_dir):
    x = v.table(spark, sf_dir, "events").selectExpr("CAST(user_id AS BIGINT) AS page", "CASE WHEN event_id % 3 = 0 THEN 0.0D ELSE value END AS conf")
    return layout.mean_confidence(x).withColumn("conf", F.round("conf", 6))


def _rows(spark, sf_dir, *fields: str):
    return v.table(spark, sf_dir, "events").selectExpr("CAST(user_id AS BIGINT) AS grp", "CAST(event_id AS BIGINT) AS pos", *fields)


@query
def sheet_fill(spark, sf_dir):
    x = _rows(spark, sf_dir, "CASE WHEN event_id % 3 = 2 THEN CAST(event_id % 25 AS BIGINT) END AS mesa", "CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS item").withColumnRenamed("grp", "sheet")
    return layout.sheet_groups(x).select("sheet", "grp", "mesa", F.array_join("items", ",").alias("items"))


@query
def location_look_ahead(spark, sf_dir):
    return layout.look_ahead(_rows(spark, sf_dir, "CASE WHEN event_type = 'view' THEN ' y ' WHEN event_type = 'click' THEN '' ELSE event_type END AS tail"))


@query
def section_merge(spark, sf_dir):
    x = _rows(spark, sf_dir, "event_type = 'click' AS bold", "event_type || CAST(event_id AS STRING) AS text").withColumnRenamed("grp", "page")
    return layout.bold_sections(x)


# the live feed


@query
def feed_latest_state(spark, sf_dir):
    return live.latest_states(v.feed(spark, sf_dir))


def _tasks(spark, sf_dir) -> int:
    """How many tasks the dashboard counts."""
    return v.feed(spark, sf_dir).select("task_id").distinct().count()


@query
def dashboard_status(spark, sf_dir):
    return live.dashboard(live.latest_states(v.feed(spark, sf_dir)), _tasks(spark, sf_dir))


@query
def leaderboard(spark, sf_dir):
    return live.leaderboard(live.latest_states(v.feed(spark, sf_dir)))


def _feed_stream(spark, sf_dir):
    schema = v.table(spark, sf_dir, "events").schema
    stream = readers.change_stream(spark, sf_dir, "events.parquet", schema) if not v.is_folder(spark, sf_dir, "events") else readers.change_stream(spark, f"{sf_dir}/events.parquet", "*.parquet", schema)
    return stream.selectExpr(*(f"{e} AS {n}" for n, e in v.FEED.items()))


@query
def status_stream(spark, sf_dir):
    """feed_latest_state as a stream, to its present end, and again without news: the second run's states."""
    top = shared_dir(spark, "status")
    live.upsert_states(_feed_stream(spark, sf_dir), f"{top}/states", f"{top}/checkpoint")
    return live.upsert_states(_feed_stream(spark, sf_dir), f"{top}/states", f"{top}/checkpoint")()


@query
def dashboard_stream(spark, sf_dir):
    """The dashboard after the last micro-batch of the feed."""
    top = shared_dir(spark, "dashboard")
    shown = live.live_dashboard(_feed_stream(spark, sf_dir), f"{top}/states", f"{top}/checkpoint", _tasks(spark, sf_dir))
    return shown.groupBy().agg(F.max_by(F.struct(*(c for c in shown.columns if c != "batch")), "batch").alias("_s")).select("_s.*")


@query
def resumable_work(spark, sf_dir):
    """Tasks that a resumed run has still to do."""
    feed = v.feed(spark, sf_dir)
    return live.unseen(feed.select("task_id").distinct(), live.latest_states(feed), "task_id")
