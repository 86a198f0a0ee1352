"""Token counts (operator 5) for a word BPE vocabulary: heap-and-linked-list pair merging.

Each word is a linked list of symbols; a heap gives the adjacent pair of lowest rank, the leftmost of equals, until no
pair has one. The count of a word is its first symbols less the merges; no identifier is ever made.

- A null text is empty and has no tokens. The special strings of the vocabulary count as one token each, as the
  tokenizer's default has it; none are added.
- Rows pass one by one: ids may be null or repeated. No shuffle; memory is one Arrow batch and a memo of MEMO words.
- Texts are whole: no truncation. A word of any length is merged with a heap of its pairs; a text that is one very long word
  is one such list.
- An empty table gives no rows. Columns other than the id and the text aren't read, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame

from rosterloom.llm.byte_bpe import _local
from rosterloom.llm.common import col, text_of

MEMO = 400_000


def _byte_symbols() -> list[str]:
    """The printable symbol that a byte-level vocabulary has for each byte: itself if printable in Latin-1, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class Counter:
    def __init__(self, spec: dict):
        """spec: the tokenizer file: a BPE model with an end-of-word suffix on byte symbols; NFC, white space and case normalised."""
        self.rank = {tuple(p.split(" ") if isinstance(p, str) else p): r for r, p in enumerate(spec["model"]["merges"])}
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.symbol = _byte_symbols()
        self.cut = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.memo: dict[str, int] = {}

    def word(self, word: str) -> int:
        s = [self.symbol[b] for b in word.encode()]
        s[-1] += self.suffix
        n, rank = len(s), self.rank.get
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i, s[i], s[i + 1]) for i in range(n - 1) if (r := rank((s[i], s[i + 1]))) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if j < 0 or s[i] != a or s[j] != b:
                continue  # one of the two has been merged since
            s[i], s[j] = a + b, ""
            after[i] = e = after[j]
            after[j] = -1
            merges += 1
            if e >= 0:
                before[e] = i
                if (r := rank((s[i], s[e]))) is not None:
                    heappush(heap, (r, i, s[i], s[e]))
            if (k := before[i]) >= 0 and (r := rank((s[k], s[i]))) is not None:
                heappush(heap, (r, k, s[k], s[i]))
        return n - merges

    def part(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # character by character: no rule for a sigma at a word's end
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        total, memo = 0, self.memo
        for w in self.cut.findall(text):
            n = memo.get(w)
            if n is None:
                if len(memo) >= MEMO:
                    memo.clear()
                n = self.word(w)
                if len(w) < 100:
                    memo[w] = n
            total += n
        return total

    def text(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.part(text)
        return len(self.special.findall(text)) + sum(map(self.part, self.special.split(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    with open(path, encoding="utf-8") as f:
        return Counter(json.load(f))


def count_tokens(df: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes and n_tokens of each row; `path` is the tokenizer file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(_local(path))
        for pdf in batches:
            yield pd.DataFrame({id: pdf["id"], "n_bytes": pdf["n_bytes"], "n_tokens": [c.text(t) for t in pdf["text"]]})

    from pyspark.sql import functions as F

    kind = df.schema[id].dataType.simpleString()
    t = text_of(text)
    return df.select(col(id).alias("id"), t.alias("text"), F.octet_length(t).cast("long").alias("n_bytes")).mapInPandas(run, f"`{id}` {kind}, n_bytes long, n_tokens long")
