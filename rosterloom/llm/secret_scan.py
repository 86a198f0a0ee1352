"""Secret scans (operator 9) with an incremental blob ledger.

Every version of every text is content-addressed (SHA-256 of its UTF-8). The ledger, a stored table, holds a row for each
pair of blob and rule-pack version that has been scanned, with its findings; only pairs not in the ledger are scanned,
each once however many paths hold the blob. Findings of the packs asked for are then joined back to all paths.

- A null text is the empty blob. Ids may be null or repeated: each row gets the findings of its blob.
- Copies are collapsed map-side before the shuffle, so a blob that a third of all rows hold is scanned once; findings are
  written by blob, so that the way back to many paths is split.
- An update that runs again after a failure scans what isn't there yet. A pair that two updates at once have added is
  read once. Entries of packs that aren't asked for, earlier versions too, stay and aren't read.
- An empty table gives no rows and no ledger entries. Columns other than the id and the text aren't read. Very long texts
  are scanned whole, one at a time.
- Spans are in code points, ends exclusive; the matches of one kind don't overlap. They come by start, then by kind in
  the order of the packs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm.common import col, text_of, written


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0  # characters of the group
    needs: str = ""  # a match holds one of these characters

    def find(self) -> Callable[[str], list[tuple[str, int, int]]]:
        cut, needs = re.compile(self.pattern, self.flags), self.needs

        def found(text: str) -> list[tuple[str, int, int]]:
            if needs and not any(c in text for c in needs):
                return []
            return [(self.kind, *m.span()) for m in cut.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]

        return found


#: A pack's name holds its version: a changed pack gets a new name, and its pairs are scanned anew.
RULES: dict[str, tuple[Rule, ...]] = {
    "base-1": (
        Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 12, ":="),
        Rule("access", r"AKIA[A-Z0-9]+", least=18),
        Rule("hex", r"[0-9a-f]{16,}", least=16),  # runs of hex digits are maximal, so shorter ones can't hide longer ones
    ),
    "keys-1": (
        Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", needs="-"),
        Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs="."),
    ),
}
#: So many pairs of blob and packs (some 100 bytes each) may be broadcast.
MAX_SENT = 200_000
ENTRY = "blob binary, rules string, found array<struct<kind:string,start:int,end:int>>"


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules: dict[str, tuple[Rule, ...]] = RULES, text: str = "text") -> DataFrame:
    """The new ledger entries (ENTRY): the pairs of blob and rule pack that `ledger` (of the same form) lacks."""
    blobs = versions.select(blob_id(text_of(text)).alias("blob"), text_of(text).alias("text"))
    packs = F.array(*map(F.lit, rules)) if rules else F.array().cast("array<string>")
    if ledger is None:
        todo = blobs.dropDuplicates(["blob"]).withColumn("packs", packs)
    else:  # what is missing is found by blobs alone; texts move only if they are to be scanned
        seen = ledger.groupBy("blob").agg(F.collect_set("rules").alias("seen"))
        missing = F.array_except(packs, F.coalesce("seen", F.array().cast("array<string>")))
        unseen = written(blobs.select("blob").distinct().join(seen, "blob", "left").select("blob", missing.alias("packs")).where(F.size("packs") > 0))
        few = unseen.limit(MAX_SENT + 1).count() <= MAX_SENT
        todo = blobs.join(F.broadcast(unseen), "blob").dropDuplicates(["blob"]) if few else blobs.dropDuplicates(["blob"]).join(unseen, "blob")
    todo = todo.where(F.size("packs") > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finders = {name: [r.find() for r in pack] for name, pack in rules.items()}
        for pdf in batches:
            rows = [(blob, name, [x for f in finders[name] for x in f(t)]) for blob, t, names in zip(pdf["blob"], pdf["text"], pdf["packs"], strict=True) for name in names]
            yield pd.DataFrame([(b, n, [{"kind": k, "start": s, "end": e} for k, s, e in found]) for b, n, found in rows], columns=["blob", "rules", "found"])

    return todo.select("blob", "text", "packs").mapInPandas(run, ENTRY)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger stored at path; None if there is none yet."""
    try:
        return spark.read.schema(ENTRY).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def update(versions: DataFrame, path: str, rules: dict[str, tuple[Rule, ...]] = RULES, text: str = "text") -> DataFrame:
    """The ledger at path, with all pairs of these versions and rules: those that it lacked are scanned and appended."""
    spark = versions.sparkSession
    scan_unseen(versions, read_ledger(spark, path), rules, text).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(ENTRY).parquet(path)


def findings(versions: DataFrame, ledger: DataFrame, rules: dict[str, tuple[Rule, ...]] = RULES, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob and its findings by these rules, by start, then kind as listed, for every row of versions."""
    order = F.array(*(F.lit(r.kind) for pack in rules.values() for r in pack)) if rules else F.array().cast("array<string>")
    own = ledger.where(F.col("rules").isin(*rules) & (F.size("found") > 0)).groupBy("blob", "rules").agg(F.first("found").alias("found"))
    flat = own.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    keyed = F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.array_position(order, x["kind"]).alias("nth"), x["end"].alias("end"), x["kind"].alias("kind")))
    flat = written(flat.select("blob", F.array_sort(keyed).alias("found")))
    out = versions.select(col(path).alias("path"), blob_id(text_of(text)).alias("blob")).join(flat, "blob", "left")
    return out.select(F.col("path").alias(path), "blob", F.coalesce("found", F.array().cast(flat.schema["found"].dataType)).alias("found"))


def span_text(found: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
