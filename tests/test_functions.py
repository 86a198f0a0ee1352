"""Scalar functions against literal cases."""

import unicodedata
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterloom.functions import decompose, numbers, rules, text
from rosterloom.functions.ratio import sequence_ratio
from rosterloom.operators import parse


def values(spark, inputs, f):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").orderBy("i").select(f(F.col("x"))).collect()]


REPAIRS = {
    "DNI 90000001. ALFA": "DNI 90000001 ALFA",
    "DNI 2 90000001 ALFA": "DNI 90000001 ALFA",
    "DNI 90000001B_ ALFA": "DNI 90000001 ALFA",
    "MT -0004": "MT-0004",
    "JUBILADOIA": "JUBILADO/A",
    "JUBILADO  /  A": "JUBILADO/A",
    "JUBILAD0 A": "JUBILADO/A",
    "6:060": "0-069",
    "0-060-MS-0001": "0-069-MS-0001",
    "0-069 MS - 0002": "0-069-MS-0002",
    "0-069 - MT - 0010": "0-069-MT-0010",
    "0-069-M5-0001": "0-069-MS-0001",
    "D-069-MS5-0007": "0-069-MS-0007",
    "0-069-.J1-0001": "0-069-J1-0001",
    "0-069-J|-0001": "0-069-J1-0001",
    "0-069-,)I-0001": "0-069-JI-0001",
    "0-069-££-0001": "0-069-EE-0001",
    "0-069-1-0001": "0-069-J1-0001",
    "0-069-DM-D454": "0-069-DM-0454",
    "0-069-PP-D0037": "0-069-PP-00037",
    "0-069-J1- 1004": "0-069-J1-1004",
    "0-069-MS-01 14": "0-069-MS-0114",
    "0-079-,1-0001": "0-079-J1-0001",
    "   ": "",
}


def test_repairs(spark):
    assert values(spark, REPAIRS, lambda x: rules.rewrite(x, rules.rules_for("069"))) == list(REPAIRS.values())
    assert len(rules.rules_for("069")) == 63 and len(rules.rules_for()) == 4


def test_rules_from_layers():
    layer = {"sanitize_rules": [{"pattern": r"(a)(b)", "replacement": r"\g<1>0\2"}, {"pattern": "x.", "replacement": "y", "literal": True}]}
    assert rules.load_rules([layer]) == (rules.Rule("(a)(b)", "$10$2"), rules.Rule("x.", "y", True))


CODES = {"PP106": "PP-0106", "MS 20": "MS-0020", "MSS 52": "MS-0052", "CEA735/6": "CEA-0735", "JUBILADOS": "JUBILADOS", "T3": "T-0003", " dm494 ": "DM-0494", "DE770 ESC 770": "DE-0770", "PP12345": "PP-12345"}


def test_school_codes(spark):
    assert values(spark, CODES, text.school_code) == list(CODES.values())
    typed = {"ms 7": "MS-0007", "MS-7": "MS-7", "x": "X", "pp 12345": "PP-12345"}
    assert values(spark, typed, text.query_code) == list(typed.values())
    bare = {"0-069-PP-0106": "PP-0106", "JUBILADO/A": "JUBILADO/A", "": "", "PP-1": "PP-1"}
    assert values(spark, bare, text.without_district) == list(bare.values())


def test_small_functions(spark):
    assert values(spark, ["jubilada x", "ap.en sede", "O-O69-ms-OO42", " otra "], text.destination) == ["JUBILADO/A", "AP. EN SEDE", "0-069-MS-0042", "OTRA"]
    assert values(spark, ["MESA: 5", "x mesa  12 y", "MESA"], text.header_number) == [5, 12, None]
    assert values(spark, ["12 x", "-3", "x1", ""], text.leading_int) == [12, -3, None, None]
    assert values(spark, ["90.000.001", "123", None], text.valid_id) == ["90000001", "", ""]
    assert values(spark, ["ZONA 3: Norte", "nada"], text.zone_header) == [(3, "Norte"), (None, "")]
    assert values(spark, ["CFP 12 x", "Sede central", "C 1"], text.typed_location) == ["CFP 12", "Sede", ""]
    assert values(spark, ["0-069-MS-0001", "SIN"], text.code_type) == ["MS", ""]
    assert values(spark, ["pag 1.jpg"], text.safe_id) == ["pag_1"]
    assert values(spark, ["a<b>Ab"], lambda x: text.highlight(x, F.lit("AB"))) == ["a&lt;b&gt;<mark>Ab</mark>"]
    assert values(spark, ['```json\n{"a": 1}\n```', "no"], lambda x: text.fenced_json(x, "struct<a:int>")["a"]) == [1, None]
    assert values(spark, ["7", "0"], lambda x: text.page_image(x.cast("int"))) == ["pages/pag_0007.jpg", None]
    assert values(spark, ["M12", "12"], text.site_number) == [12, None]


def test_numbers(spark):
    row = spark.range(1).select(
        numbers.half_even(F.lit(2.5)).alias("a"), numbers.half_up(F.lit(2.5)).alias("b"), numbers.percent(F.lit(1), F.lit(0)).alias("c"), numbers.capped_percent(F.lit(90)).alias("d"),
        numbers.marker_size(F.lit(10)).alias("e"), F.round(numbers.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), 3).alias("f"), numbers.stand_in_page(F.lit("x")).alias("g"),
    ).first()
    assert tuple(row)[:6] == (2.0, 3, 0.0, 100, 15, 111.195) and 1000 <= row["g"] < 10000


def test_names(spark):
    df = spark.createDataFrame([("ÁLFA  UNO", "alfa uno"), ("ALFA BETA", "ALFA BETO"), ("ABC", "ABD"), ("", ""), ("", "X")], "a string, b string")
    assert [r[0] for r in df.select(text.names_match(F.col("a"), F.col("b"))).collect()] == [True, True, False, True, False]
    better = spark.createDataFrame([("", "X"), ("A$", ""), ("A", ""), ("A", "B|"), ("ABCD", "A"), ("ABC", "A"), ("Á", "A"), (None, None)], "p string, n string")
    assert [r[0] for r in better.select(text.better_name(F.col("p"), F.col("n"))).collect()] == [False, False, True, True, True, False, True, False]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("abÑñ $", max_size=8), st.text("abÑñ $", max_size=8)), min_size=1, max_size=20))
def test_ratio_is_that_of_matching_blocks(spark, pairs):
    got = [r[0] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").orderBy("i").select(sequence_ratio("a", "b")).collect()]
    assert got == [SequenceMatcher(None, a.upper(), b.upper()).ratio() if a and b else 0.0 for a, b in pairs]


LINES = [
    "MESA: 5",
    "DNI 90000001 ALFA UNO  0-069-MS-0042 5",
    "DNI 90000002. BETA DOS  D-069-MS5-0007 7",
    "LC 9000003 GAMMA TRES  JUBILADO/A 5",
    "DNI 90000004 DELTA CUATRO 0-069-EE-0501",
    "DNI 90000005 EPSILON 0-069-PP-D0037 8",
    "|||---...===",
    "x 90000006 ZETA SEIS OCHO 0-069-MS-0001",
    "DNI 12",
]


def test_cascade_and_context(spark):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(LINES)], "page long, pos long, line string")
    parsed = parse.parse_lines(lines)
    got = [tuple(r) for r in parse.records(parsed).orderBy("pos").select("pos", "documento", "nombre", "destino", "mesa", F.round("confianza", 2)).collect()]
    assert got == [
        (1, "90000001", "ALFA UNO", "0-069-MS-0042", 5, 0.7),
        (2, "90000002", "BETA DOS", "0-069-MS-0007", 7, 0.7),
        (3, "9000003", "GAMMA TRES", "JUBILADO/A", 5, 0.7),
        (4, "90000004", "DELTA CUATRO", "0-069-EE-0501", 5, 0.5),
        (5, "90000005", "EPSILON", "0-069-PP-0003", 5, 0.5),
        (7, "90000006", "ZETA SEIS OCHO", "0-069-MS-0001", 0, 1.0),
    ]
    assert [tuple(r) for r in parse.rejects(parsed).orderBy("pos").collect()] == [(1, 6, "|||---...===", False), (1, 8, "DNI 12", True)]


@pytest.mark.parametrize("n, tier", [(30, "BUENA"), (15, "REGULAR"), (14, "MALA")])
def test_tiers(spark, n, tier):
    recs = spark.createDataFrame([(1, i, "DNI", "90000001", "ALFA", "X", 1, 0.7) for i in range(n)], "page long, pos long, tipo string, documento string, nombre string, destino string, mesa long, confianza double")
    row = parse.page_quality(recs).first()
    assert row["calidad"] == tier and row["completitud"] == round(n / 60 * 100, 1)


def test_decomposition_of_every_code_point(spark):
    """As the standard has it, for every code point of all planes, alone and in a text."""
    points = [i for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    runs = ["".join(map(chr, points[i : i + 64])) for i in range(0, len(points), 64)]
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    got = spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "i int, x string").select("i", decompose.without_marks(F.col("x"))).collect()
    wrong = [runs[i] for i, t in got if t != "".join(map(plain, runs[i]))]
    assert not wrong, wrong[:3]
    cases = ["\ufb01n", "Ａｂ", "e\u0301a", "한글 각", "½", "", "plain", None, "Ⅷ ﷺ"]
    assert values(spark, cases, decompose.without_marks) == [None if c is None else plain(c) for c in cases]
