"""Ordered text-repair rules as data, applied as one column expression."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Rule(NamedTuple):
    pattern: str
    replacement: str
    literal: bool = False


# The repairs, in the order in which they apply. Java regular expressions, $n for groups.
BASE_RULES = (
    Rule(r"""^((?:DNI|L[CE])\s+\d{4,9})[.,;:"'_]+""", "$1"),
    Rule(r"^((?:DNI|L[CE])\s+)\d\s+(\d{4,9})", "$1$2"),
    Rule(r"^((?:DNI|L[CE])\s+\d{7,8})[A-Z_]+\s", "$1 "),
    Rule(r"(\b[A-Z]{2})\s+-(\d{4})", "$1-$2"),
)
DISTRICT_RULES = {
    "069": (
        Rule("JUBILADOIA", "JUBILADO/A", True),
        Rule("JUBILADOVA", "JUBILADO/A", True),
        Rule("JUBILADO / A", "JUBILADO/A", True),
        Rule(r"JUBILADO\s*/\s*A", "JUBILADO/A"),
        Rule(r"JUBILAD[O0]\s*[/|\\]?\s*A\b", "JUBILADO/A"),
        Rule(r"6\s*[:\-]\s*060\b", "0-069"),
        Rule(r"6[.-]660\b", "0-069"),
        Rule(r"\b0[.\s]060\b", "0-069"),
        Rule(r"\b0[.\s]066\b", "0-069"),
        Rule("0-060-", "0-069-", True),
        Rule("0-066-", "0-069-", True),
        Rule("0-065-", "0-069-", True),
        Rule("0-000-", "0-069-", True),
        Rule(r"(0-069)\s+([A-Z]{2})\s*-\s*(\d{4})", "$1-$2-$3"),
        Rule(r"(0-069)\s*-\s*([A-Z]{2})\s*-\s*(\d{4})", "$1-$2-$3"),
        Rule(r"(0-069-[A-Z]{2})\s+(\d{4})", "$1-$2"),
        Rule("0-069-M5-", "0-069-MS-", True),
        Rule("0-069-15-", "0-069-IS-", True),
        Rule("D-069-", "0-069-"),
        Rule("0-0692-", "0-069-"),
        Rule("0-D69-", "0-069-"),
        Rule(r"(0-069-)\s+", "$1"),
        Rule(r"0-069-[.,](J[1I])", "0-069-$1"),
        Rule(r"0-069-[.,](\d)", "0-069-$1"),
        Rule(r"0-069-J[|!]", "0-069-J1"),
        Rule(r"0-069-\)1", "0-069-J1"),
        Rule(r"0-069-[.,;]1-", "0-069-J1-"),
        Rule(r"0-069-[.,;]I-", "0-069-JI-"),
        Rule(r"0-069-\.J", "0-069-J"),
        Rule(r"0-069-\.1-", "0-069-J1-"),
        Rule(r"0-069-1-(\d{4})", "0-069-J1-$1"),
        Rule(r"0-069-[,.]?\)?\[I1]-", "0-069-J1-"),  # matches the literal text [I1]- only
        Rule(r"0-069-,\)I-", "0-069-JI-"),
        Rule("£E", "EE", True),
        Rule("E£", "EE", True),
        Rule("A£", "AE", True),
        Rule("££", "EE", True),
        Rule(r"EL\.-", "EL-"),
        Rule(r"T\.J", "TJ"),
        Rule("0-069-MS5-", "0-069-MS-"),
        Rule("0-069-M3S-", "0-069-MS-"),
        Rule("0-069-8B5-", "0-069-BS-"),
        Rule("0-069-8BS-", "0-069-BS-"),
        Rule("0-069-85S-", "0-069-BS-"),
        Rule("0-069-A4A-", "0-069-AA-"),
        Rule("0-069-D0F-", "0-069-DF-"),
        Rule("0-069-D0M-", "0-069-DM-"),
        Rule("0-069-0DM-", "0-069-DM-"),
        Rule("0-069-S5C-", "0-069-SC-"),
        Rule("0-069-0F-", "0-069-DF-"),
        Rule("0-069-1S5-", "0-069-1S-"),
        Rule(r"0-069-M-(\d{4})", "0-069-MS-$1"),
        Rule(r"0-069\.([A-Z])", "0-069-$1"),
        Rule(r"(0-069-[A-Z]{2}-)D(\d{3,4})", "$10$2"),  # group 1, then a zero: there is no group 10
        Rule(r"(0-069-[A-Z]{2}-)D0+(\d{3,4})", "$1$2"),
        Rule(r"(0-069-[A-Z\d]{2}-)\s+(\d)", "$1$2"),
        Rule(r"(0-069-[A-Z]{2}-\d{2})\s+(\d{2})\b", "$1$2"),
        Rule(r"0-089-\.1-", "0-089-J1-"),
        Rule(r"(0-0[6-8]9-),1-", "$1J1-"),
    )
}
#: Destinations that are no school.
SPECIAL = ("JUBILADO/A", "AP. EN SEDE")

WHITE = " \t\n\x0b\x0c\r"


def rules_for(district: str | None = None) -> tuple[Rule, ...]:
    """The base rules and, if it has any, a district's after them."""
    return BASE_RULES + DISTRICT_RULES.get(district or "", ())


def rewrite(text: Column, rules: tuple[Rule, ...]) -> Column:
    """text without white space at its ends, then each rule once, in order."""
    out = F.btrim(text, F.lit(WHITE))
    for r in rules:
        out = F.replace(out, F.lit(r.pattern), F.lit(r.replacement)) if r.literal else F.regexp_replace(out, r.pattern, r.replacement)
    return out


def load_rules(layers: list[dict]) -> tuple[Rule, ...]:
    """Rules from parsed configuration layers, the base first; \\1 and \\g<1> stand for groups there."""
    import re

    out = []
    for layer in layers:
        for r in layer.get("sanitize_rules", []):
            literal = bool(r.get("literal"))
            new = r["replacement"] if literal else re.sub(r"\\(?:g<(\d)>|(\d))", lambda m: f"${m[1] or m[2]}", r["replacement"])
            out.append(Rule(r["pattern"], new, literal))
    return tuple(out)
