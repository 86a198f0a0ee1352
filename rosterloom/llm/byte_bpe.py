"""Byte-level BPE encoding and decoding (operator 8) by corpus-level merge replay.

1. Documents become a chunk table (see chunks) of word numbers: the pattern cuts a text into words without loss, so a
   chunk is its distinct words, and for each document the numbers of its words.
2. The words that a chunk holds SHARED times or more, and that are no token themselves, meet by word, once for the
   corpus: an inverted index leads from a merge to all word positions that it applies to; merges are applied in rank
   order to all words of a block at once, and only the neighbours of a merged pair are looked at again.
3. The ids of these words go back to the chunks by a join, one row for each word and chunk. The rare words of a chunk,
   which no other chunk is likely to hold, are replayed in the same way where they are. Each distinct word of a chunk
   gets its ids, their text and their bytes once; documents are put together from these.

- A null text is empty: no tokens. Repeated rows and ids pass row by row; ids may be null. An empty table gives no rows.
- Memory: the words of one chunk, or one block of distinct words. A longer text is a chunk of its own; texts are never cut.
- A word of more than LONG bytes is replayed by itself, in n log n steps.
- Columns of the input other than the id and the text don't matter and aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.chunks import chunk_table, frame, give_back, pack, texts_of, unpack
from rosterloom.llm.common import col, text_of

CHUNK_BYTES = 4 << 20
SHARED = 4
#: Words of up to so many bytes are replayed together, in blocks of about so many bytes.
LONG, BLOCK = 64, 3_000_000
#: Words whose ids a worker remembers from one chunk to the next.
MEMO = 400_000
_NONE = 1 << 40


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """The rank file: base64 of a token, its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Which rank the merge of two tokens (by their ranks) has."""

    def __init__(self, ranks: dict[bytes, int]):
        get = ranks.get
        self.byte = np.array([ranks.get(bytes([b]), _NONE) for b in range(256)], np.int64)
        self.of = {a << 32 | b: r for t, r in ranks.items() for i in range(1, len(t)) if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None}
        keys = np.fromiter(self.of, np.int64, len(self.of))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(self.of.values(), np.int64, len(self.of))[order]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        if len(key) < 24:
            return np.array([self.of.get(k, _NONE) for k in key.tolist()], np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def replay(words: list[bytes], merges: Merges) -> list[list[int]]:
    """The token ids of each word: in every word the adjacent pair of lowest rank is merged first, the leftmost of equals."""
    out: list[list[int]] = [_alone(w, merges) if len(w) > LONG else [] for w in words]
    short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG]
    first = size = 0
    for k, n in enumerate([*(len(words[i]) for i in short), BLOCK + 1]):
        if size + n > BLOCK:
            for j, ids in zip(short[first:k], _together([words[j] for j in short[first:k]], merges), strict=True):
                out[j] = ids
            first, size = k, 0
        size += n
    return out


def _together(words: list[bytes], merges: Merges) -> Iterator[list[int]]:
    if not words:
        return
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    token = merges.byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    word = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1] = before[ends - sizes] = -1
    pair, alive = np.full(n, _NONE), np.ones(n, bool)  # the rank of each token's merge with the next
    inner = np.flatnonzero(after >= 0)
    pair[inner] = merges(token[inner], token[inner + 1])
    index: dict[int, list[int]] = defaultdict(list)  # rank of a merge -> positions of its left tokens
    heap: list[int] = []

    def add(at: np.ndarray, rank: np.ndarray) -> None:
        if len(at) < 24:
            for i, r in zip(at.tolist(), rank.tolist()):
                if r != _NONE:
                    if r not in index:
                        heappush(heap, r)
                    index[r].append(i)
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        starts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        for r, a, b in zip(rank[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(at)]):
            if r != _NONE:
                if r not in index:
                    heappush(heap, r)
                index[r] += at[a:b].tolist()

    add(inner, pair[inner])
    while heap:
        rank = heappop(heap)
        at = np.array(index.pop(rank))
        at = at[pair[at] == rank]  # else a neighbour has been merged since
        if len(at) > 1:
            at.sort()
            again = np.append(False, word[at[1:]] == word[at[:-1]])
            if again.any():  # one merge in a word at a time: a pair that it makes may go first
                index[rank] = at[again].tolist()
                heappush(heap, rank)
                at = at[~again]
        if not len(at):
            continue
        gone = after[at]
        ahead, behind = after[gone], before[at]
        token[at], after[at], alive[gone], pair[gone], pair[at] = rank, ahead, False, _NONE, _NONE
        some = ahead >= 0
        left, right = at[some], ahead[some]
        before[right] = left
        pair[left] = one = merges(token[left], token[right])
        some = behind >= 0
        back = behind[some]
        pair[back] = two = merges(token[back], token[at[some]])
        add(np.concatenate([left, back]), np.concatenate([one, two]))
    ids, stop = token[alive].tolist(), np.cumsum(np.bincount(word[alive], minlength=len(words))).tolist()
    for a, b in zip([0, *stop], stop):
        yield ids[a:b]


def _alone(word: bytes, merges: Merges) -> list[int]:
    """The same for one long word: its index is a heap of (rank, position)."""
    token = merges.byte[np.frombuffer(word, np.uint8)].tolist()
    n, of = len(token), merges.of.get
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := of(token[i] << 32 | token[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i, a, b = heappop(heap)
        j = after[i]
        if j < 0 or token[i] != a or token[j] != b:
            continue
        token[i], token[j] = rank, -1
        after[i], after[j] = after[j], -1
        if (e := after[i]) >= 0:
            before[e] = i
            if (r := of(rank << 32 | token[e])) is not None:
                heappush(heap, (r, i, rank, token[e]))
        if (b := before[i]) >= 0 and (r := of(token[b] << 32 | rank)) is not None:
            heappush(heap, (r, b, token[b], rank))
    return [t for t in token if t >= 0]


# words ----------------------------------------------------------------------------------------------

_LATIN = 0x250


def _class(kind: str) -> str:
    """The characters before _LATIN of a general category, as the inside of a class."""
    return "".join(f"\\u{i:04x}" for i in range(_LATIN) if unicodedata.category(chr(i))[0] == kind)


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of the pattern. Texts of Latin characters alone go through re, which is faster, with classes written out."""
    slow = regex.compile(pattern).findall
    letters, numbers, white = _class("L"), _class("N"), r"\t-\r\x20\x85\xa0"
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]")
    for name, own in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\s", f"[{white}]"), (r"\S", f"[^{white}]")):
        plain = plain.replace(name, own)
    if re.search(r"\\[pPwWdDbB]|\[[^\]]*\[", plain):  # a pattern of another kind
        return slow
    fast, wide = re.compile(plain).findall, re.compile(f"[^\\x00-\\u{_LATIN - 1:04x}]").search
    return lambda text: slow(text) if wide(text) else fast(text)


class Coder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut, self.merges = ranks, cutter(pattern), Merges(ranks)
        self.token = {r: t for t, r in ranks.items()}
        self.memo: dict[str, list[int]] = {}
        self.memo_before: dict[str, list[int]] = {}

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; those that this worker has replayed lately are remembered, in two generations of half of MEMO."""
        new, old = self.memo, self.memo_before
        out = [new.get(w) or old.get(w) for w in words]
        todo = [i for i, x in enumerate(out) if x is None]
        raw = [words[i].encode() for i in todo]
        whole = [self.ranks.get(r) for r in raw]  # a whole token needs no merges
        merged = iter(replay([r for r, rank in zip(raw, whole, strict=True) if rank is None], self.merges))
        for i, r, rank in zip(todo, raw, whole, strict=True):
            out[i] = next(merged) if rank is None else [rank]
            if 0 < len(r) <= LONG:
                if len(new) >= MEMO // 2:
                    self.memo_before = new
                    new = self.memo = {}
                new[words[i]] = out[i]
        return out

    def block(self, texts: list[str]) -> Iterator[list[list[int]]]:
        """For each text the ids of each of its words."""
        cut = [self.cut(t) for t in texts]
        words = list({w: None for p in cut for w in p})
        known = dict(zip(words, self.ids_of(words), strict=True))
        for p in cut:
            yield [known[w] for w in p]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """One for each Python worker."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(ranks_of(_local(path)), pattern)
    return _CODERS[path, pattern]


# the operator ---------------------------------------------------------------------------------------


def _numbered(df: DataFrame, path: str, pattern: str, id: str, text: str, chunk_bytes: int, shared: int) -> DataFrame:
    """The chunk table: ids and numbers of words of the documents, the distinct words, and those of them that the corpus replays."""

    def about(table: pa.Table) -> dict[str, list]:
        c, known, numbers, sizes = coder(path, pattern), {}, [], []
        for t in texts_of(table, text):
            own = [known.setdefault(w, len(known)) for w in c.cut(t)]
            numbers.append(np.array(own, np.uint32))
            sizes.append(len(own))
        numbers = np.concatenate(numbers)
        often = np.flatnonzero(np.bincount(numbers, minlength=len(known)) >= shared)
        words = list(known)
        own = [i for i in often.tolist() if words[i].encode() not in c.ranks]
        planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T)
        docs = pack(pa.table({"id": table[id], "n": pa.array(sizes, pa.int64())}))
        held = pack(pa.table({"words": pa.array([pa.scalar(x, pa.large_binary()) for x in (planes.tobytes(), "".join(words).encode())]), "sizes": pa.array([[len(planes[0])], list(map(len, words))], pa.list_(pa.int32()))}))
        return {"docs": docs, "held": held, "often": own, "shared": [words[i] for i in own]}

    return chunk_table(df.select(col(id), text_of(text).alias(text)), text, about, "held binary, often array<int>, shared array<string>", chunk_bytes)


def _answers(chunks: DataFrame, path: str, pattern: str) -> DataFrame:
    """(_chunk, ids): the ids of the shared words of each chunk, as int32 bytes, in order; each distinct word is replayed once."""
    each = chunks.select("chunk", F.posexplode("shared").alias("at", "w"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, held, size = coder(path, pattern), [], 0

        def done() -> pd.DataFrame:
            return pd.DataFrame({"w": held, "ids": [np.array(x, "<i4").tobytes() for x in c.ids_of(held)]})

        for pdf in batches:
            held += pdf["w"].tolist()
            size += sum(map(len, pdf["w"]))
            if size > BLOCK:
                yield done()
                held, size = [], 0
        yield done()

    known = each.select("w").distinct().mapInPandas(run, "w string, ids binary")
    back = each.join(known, "w").groupBy(F.col("chunk").alias("_chunk")).agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("x"))
    return back.select("_chunk", F.transform("x", lambda x: x["ids"]).alias("ids"))


def _through(df: DataFrame, path: str, pattern: str, id: str, text: str, out: str, rows: Callable, chunk_bytes: int, shared: int) -> DataFrame:
    """id and the columns `out` of each row: `rows` makes these of a chunk's coder, ids by word, and word numbers by document."""
    chunks = _numbered(df, path, pattern, id, text, chunk_bytes, shared)
    kind = df.schema[id].dataType.simpleString()

    def made(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c, one = coder(path, pattern), left.iloc[0]
        held, docs = unpack(one["held"]).to_pylist(), unpack(one["docs"])
        n = held[0]["sizes"][0]
        numbers = np.ascontiguousarray(np.frombuffer(held[0]["words"], np.uint8).reshape(4, n).T).view(np.uint32).ravel()
        whole, stop = held[1]["words"].decode(), np.cumsum(held[1]["sizes"], dtype=np.int64).tolist()
        words = [whole[a:b] for a, b in zip([0, *stop], stop)]
        ids: list = [None] * len(words)
        if len(right):
            for i, x in zip(one["often"].tolist(), right["ids"].iloc[0], strict=True):
                ids[i] = np.frombuffer(x, "<i4").tolist()
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(rest, c.ids_of([words[i] for i in rest]), strict=True):
            ids[i] = x
        frame_ = frame(docs.select(["id"])).rename(columns={"id": id})
        made_ = rows(c, ids, numbers, np.cumsum(docs["n"].to_numpy()))
        give_back()
        return frame_.assign(**made_)

    sent = chunks.select("chunk", "docs", "held", "often").groupBy("chunk").cogroup(_answers(chunks, path, pattern).groupBy("_chunk"))
    return sent.applyInPandas(made, f"`{id}` {kind}, {out}")


def encode(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", back: bool = False, chunk_bytes: int = CHUNK_BYTES, shared: int = SHARED) -> DataFrame:
    """id, token_ids (array<int>) of each row and, if `back`, the SHA-256 of the bytes that they decode to (decoded_sha256). `path` is the rank file, on every machine or sent with addFile."""

    def rows(c: Coder, ids: list[list[int]], numbers: np.ndarray, stops: np.ndarray) -> dict:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat, start = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum())), np.cumsum(sizes) - sizes
        out: dict = {"token_ids": []}
        for a, b in zip([0, *stops.tolist()], stops.tolist()):
            own = numbers[a:b]
            n = sizes[own]
            out["token_ids"].append(flat[np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        if back:
            raw = [c.decode(x) for x in ids]
            out["decoded_sha256"] = [hashlib.sha256(b"".join(map(raw.__getitem__, numbers[a:b].tolist()))).hexdigest() for a, b in zip([0, *stops.tolist()], stops.tolist())]
        return out

    return _through(df, path, pattern, id, text, "token_ids array<int>" + ", decoded_sha256 string" * back, rows, chunk_bytes, shared)


def decode(df: DataFrame, path: str, id: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """id, decoded (the bytes, which need not be UTF-8) of each row of token ids; null ids give no bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = {r: t for t, r in ranks_of(_local(path)).items()}
        for pdf in batches:
            yield pd.DataFrame({id: pdf["id"], "decoded": [b"" if x is None else b"".join(map(token.__getitem__, x)) for x in pdf["ids"]]})

    kind = df.schema[id].dataType.simpleString()
    return df.select(col(id).alias("id"), col(ids).alias("ids")).mapInPandas(run, f"`{id}` {kind}, decoded binary")


def digests(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, shared: int = SHARED) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of each row; the ids stay in the task that makes them."""

    def rows(c: Coder, ids: list[list[int]], numbers: np.ndarray, stops: np.ndarray) -> dict:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        told, raw = [" ".join(map(str, x)) for x in ids], [c.decode(x) for x in ids]
        out: dict = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for a, b in zip([0, *stops.tolist()], stops.tolist()):
            own = numbers[a:b].tolist()
            out["n_tokens"].append(int(sizes[numbers[a:b]].sum()))
            out["ids_sha256"].append(hashlib.sha256(" ".join(map(told.__getitem__, own)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(b"".join(map(raw.__getitem__, own))).hexdigest())
        return out

    return _through(df, path, pattern, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows, chunk_bytes, shared)


def _local(path: str) -> str:
    return SparkFiles.get(path.removeprefix("files:")) if path.startswith("files:") else path
