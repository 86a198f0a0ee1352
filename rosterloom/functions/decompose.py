"""Full compatibility decomposition (NFKD) of text without its combining marks, as column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the standard: where composed Hangul syllables and their parts begin, and how many parts there are.
HANGUL, LEADS, VOWELS, TAILS = 0xAC00, (0x1100, 19), (0x1161, 21), (0x11A7, 28)
_LAST = HANGUL + LEADS[1] * VOWELS[1] * TAILS[1] - 1


@lru_cache(maxsize=1)
def tables() -> tuple[str, str, tuple[str, ...], tuple[str, ...]]:
    """Characters that become one (those that go, the marks, last) and what they become; characters that become several, and those.

    Made from the standard's properties over all code points; Hangul syllables are left to arithmetic.
    """
    one, one_to, gone, several, several_to = [], [], [], [], []
    for i in range(0x80, 0x110000):
        if not (0xD800 <= i < 0xE000 or HANGUL <= i <= _LAST):
            c = chr(i)
            if unicodedata.combining(c) or unicodedata.decomposition(c):
                plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
                if not plain:
                    gone.append(c)
                elif len(plain) == 1 and plain != c:
                    one.append(c)
                    one_to.append(plain)
                elif len(plain) > 1:
                    several.append(c)
                    several_to.append(plain)
    return "".join(one + gone), "".join(one_to), tuple(several), tuple(several_to)


def _syllable(c: Column) -> Column:
    """The letters of a composed Hangul syllable."""
    s = F.ascii(c) - F.lit(HANGUL)
    letter = lambda part, i: F.element_at(F.array(*(F.lit(chr(part[0] + k) if k or part is not TAILS else "") for k in range(part[1]))), i.cast("int") + 1)
    per = VOWELS[1] * TAILS[1]
    return F.concat(letter(LEADS, F.floor(s / per)), letter(VOWELS, F.floor((s % per) / TAILS[1])), letter(TAILS, s % TAILS[1]))


def _ranges(points: list[int]) -> str:
    """The members of a character class, runs of code points as ranges: a class is tried range by range."""
    out, first = [], points[0]
    for a, b in zip(points, [*points[1:], -1], strict=True):
        if b != a + 1:
            out.append(f"\\x{{{first:x}}}" + (f"-\\x{{{a:x}}}" if a > first else ""))
            first = b
    return "".join(out)


def _ascii(x: Column) -> Column:
    return F.octet_length(x) == F.char_length(x)


def without_marks(x: Column) -> Column:
    """x in its compatibility decomposition, without combining marks.

    Text in plain ASCII, most of it, is passed as it is. Characters that become one are translated; only where that leaves
    others than ASCII is it looked for those that become several.
    """
    one, one_to, several, several_to = tables()
    members = _ranges(sorted([*map(ord, several), *range(HANGUL, _LAST + 1)]))
    joined, targets = F.lit("".join(several)), F.split(F.lit("\x01".join(several_to)), "\x01")

    def spelled(c: Column) -> Column:
        at = F.instr(joined, c)
        return F.when(_ascii(c), c).when(c.between(chr(HANGUL), chr(_LAST)), _syllable(c)).when(at > 0, F.element_at(targets, at)).otherwise(c)

    def rest(y: Column) -> Column:
        letters = F.filter(F.split(y, ""), lambda c: c != "")
        return F.when(_ascii(y), y).when(y.rlike(f"[{members}]"), F.array_join(F.transform(letters, spelled), "")).otherwise(y)

    # bound by a lambda, so that the translated text is made once
    return F.when(_ascii(x), x).otherwise(F.transform(F.array(F.translate(x, one, one_to)), rest)[0])
