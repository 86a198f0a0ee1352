"""Recognition by several engines, page by page: the first on all pages, the others only where it was unsure."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.operators import parse
from rosterloom.operators.reconcile import hybrid_gate, vote
from rosterloom.sources.shared import written


@runtime_checkable
class Engine(Protocol):
    """What an engine has to offer: its name, whether it can run, and the text and confidence of pages."""

    name: str

    def is_available(self) -> bool: ...

    def recognise(self, pages: DataFrame) -> DataFrame:
        """(page, confianza double, text) of pages (page, ...), a row for each."""
        ...


def check_engine(engine: Engine, pages: DataFrame) -> None:
    """A TypeError that says what an engine lacks: the contract's test, for any engine and some pages."""
    if not isinstance(engine, Engine):
        raise TypeError(f"{engine!r} lacks one of name, is_available, recognise")
    got = engine.recognise(pages)
    missing = {"page", "confianza", "text"} - set(got.columns)
    if missing:
        raise TypeError(f"{engine.name} gives no {', '.join(sorted(missing))}")
    if got.select("page").distinct().count() != got.count():
        raise TypeError(f"{engine.name} gives a page twice")


def read_text(texts: DataFrame) -> DataFrame:
    """The records (page, pos, tipo, documento, nombre, destino, mesa, confianza) of recognised text."""
    return parse.records(parse.parse_lines(parse.page_lines(texts))).drop("raw")


def cascade(pages: DataFrame, primary: Engine, fallback: Engine | None = None, vision: Engine | None = None, fallback_below: float = 0.6, vision_below: float = 0.4, least: float = 0.0, read: Callable[[DataFrame], DataFrame] = read_text) -> DataFrame:
    """(page, engine_used, pos, tipo, documento, nombre, destino, mesa, confianza) of pages.

    The primary's confidence alone decides: below the first bound the fallback reads the page, too, below the second one the
    vision engine if it is available. Records of pages that several engines have read are merged by vote within the page;
    those of one engine stay as they are, repeats too. Each engine's answers are written, so that no page is sent twice.
    """
    first = written(primary.recognise(pages).select("page", "confianza", "text"))
    gates = hybrid_gate(first.select("page", "confianza"), fallback_below, vision_below)
    answers = [(primary, first)]
    for engine, gate in ((fallback, "usa_respaldo"), (vision, "usa_vision")):
        if engine is not None and (engine is fallback or engine.is_available()):
            sent = pages.join(gates.where(gate).select("page"), "page", "left_semi")
            answers.append((engine, written(engine.recognise(sent).select("page", "confianza", "text"))))
    parts = [read(a.select("page", "text")).withColumns({"engine": F.lit(e.name), "engine_no": F.lit(i).cast("long")}) for i, (e, a) in enumerate(answers, 1)]
    all_records = parts[0]
    for p in parts[1:]:
        all_records = all_records.unionByName(p)
    read_by = answers[0][1].select("page", F.lit(1).alias("_no"), F.lit(primary.name).alias("_name"))
    for i, (e, a) in enumerate(answers[1:], 2):
        read_by = read_by.unionByName(a.select("page", F.lit(i).alias("_no"), F.lit(e.name).alias("_name")))
    used = read_by.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("_no", "_name"))).alias("_e"))
    used = written(used.select("page", F.array_join(F.transform("_e", lambda x: x["_name"]), "+").alias("engine_used"), F.size("_e").alias("_engines")))
    rows = all_records.join(used, "page")
    alone = rows.where("_engines = 1")
    merged = vote(rows.where("_engines > 1").withColumn("ord", F.col("pos")), by=("page", "engine_used"))
    columns = ["page", "engine_used", "pos", "tipo", "documento", "nombre", "destino", "mesa", "confianza"]
    out = alone.select(columns).unionByName(merged.withColumn("pos", F.lit(None).cast("bigint")).select(columns))
    return out.where(F.col("confianza") >= least)
