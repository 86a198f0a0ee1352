"""The registered queries of the ten operators, at their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import byte_bpe, decontaminate, divergence, kn_quality, line_dedup, mpeg_media, near_dup, secret_scan, suffix_dedup, token_counts, toxicity, vector_codes, warc
from rosterloom.llm.chunks import forget, made
from rosterloom.llm.common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumns({c: F.round(c, 6) for c in ("perplexity", "threshold")})


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.through_archives(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = made()
    try:
        _, rows = near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    finally:
        forget(spark, since)  # rows are of written tables
    return rows.select(F.col("id").alias("doc_id"), "n_words", "class_id", "class_size")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = made()
    try:
        out = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    finally:
        forget(spark, since)
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["first"].cast("string"), x["last"].cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_repeated", spans.alias("spans"), "class_id", "class_size")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    ids = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), ids.alias("items_sha256"), "contaminated")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger in two versions of the documents, an earlier one with the lower half of the ids, then all: the second scan finds what the first one lacks.

    The ledger is of this call alone: what another call has scanned doesn't count here."""
    docs, path = table(spark, sf_dir, "documents"), shared_dir(spark, "ledger")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    if middle is not None:
        secret_scan.update(docs.where(F.col("doc_id") <= middle), path)
    out = secret_scan.findings(docs, secret_scan.update(docs, path))
    base = F.filter("found", lambda x: x["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"), secret_scan.span_text(F.col("found")).alias("spans"))


def op10_mpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mpeg_media.media_columns(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "duration_s", "frame_offsets", "intact")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    near = F.transform("near", lambda x: F.concat_ws(":", x["id"], F.round(x["cosine"], 6).cast("string"), x["toxic"].cast("string"), x["examples"].cast("string")))
    return out.select("doc_id", "held_out", "score", "predicted", F.array_join("terms", ",").alias("terms"), F.array_join(near, ",").alias("near"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    code = F.lower(F.array_join(F.transform("code", lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    sha = F.lit(vector_codes.books_sha256(books) if books else None).cast("string")
    return out.select("vec_id", code.alias("code"), "error", "label_error", sha.alias("codebooks_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_kn_quality, op2_warc, op3_near_dup, op4_suffix_dedup, op5_token_counts, op6_line_dedup, op7_decontaminate, op8_byte_bpe, op9_secret_scan, op10_mpeg_media, op11_toxicity, op12_vector_codes, op13_source_divergence)}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
             d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
             t AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS top FROM d)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM t""",
    "op6_line_dedup": f"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
             k AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
             hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
        FROM k LEFT JOIN hot USING (key) GROUP BY doc_id""",
    "op7_decontaminate": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
             b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
             bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
                    FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
             ns AS (SELECT DISTINCT n FROM bw),
             dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
                    FROM (SELECT w.doc_id, w.ws, ns.n, unnest(range(1, len(w.ws) - ns.n + 2)) AS i FROM w, ns WHERE len(w.ws) >= ns.n)),
             hit AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
             pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit),
             cnt AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
             its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
                     FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
        SELECT w.doc_id, len(w.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN cnt USING (doc_id) LEFT JOIN its USING (doc_id)""",
}

SQL["op13_source_divergence"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
         g AS (SELECT DISTINCT lang, source FROM d),
         t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
         k AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
         c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
         v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
         s AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
         a AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY 1),
         p AS (SELECT lang, source, term, coalesce(n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS BIGINT) AS p
               FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
         q AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(total) + 5 * any_value(v)) AS BIGINT) AS q
               FROM c JOIN a USING (lang) JOIN v USING (lang) GROUP BY ALL),
         pairs AS (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
                   FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
         every AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
                   FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
                   UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every)
    WHERE part = 'pair' OR rank <= 50"""


def _vector_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds one after another: x the parts of the vectors, b the codebooks, n the nearest entries."""
    nearest = """SELECT x.vec_id, x.p, arg_min(b.e, d * 256 + b.e) AS e, CAST(min(d) AS BIGINT) AS d
        FROM x JOIN {book} b ON x.p = b.p, LATERAL (SELECT list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, b.v) + list_dot_product(b.v, b.v) AS d) GROUP BY ALL"""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"n{i} AS MATERIALIZED ({nearest.format(book=f'b{i}')})")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT p, e, i, floor(sum(c) / count(*)) AS c FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM n{i} JOIN x USING (vec_id, p)) GROUP BY ALL),
            b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(w, b{i}.v) AS v FROM b{i} LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS w FROM m{i} GROUP BY ALL) USING (p, e))""")
    return f"""
    WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda y: floor(1024 * CAST(y AS DOUBLE))) AS v FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
         x AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) r(p)),
         b0 AS MATERIALIZED (SELECT p, e, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id)),
         {", ".join(steps)},
         books AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS sha FROM (SELECT p, e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM b{rounds})),
         codes AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM n{rounds} GROUP BY ALL)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM codes JOIN kept USING (vec_id), books"""


SQL["op12_vector_codes"] = _vector_sql()


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
