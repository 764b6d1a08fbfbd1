"""Byte-level BPE encoding and decoding with a contiguous rank array.

A short word is a list of part ids beside a list of the ranks of neighbouring parts. The least rank is found
by a scan, its boundary is deleted and the two neighbouring ranks are looked up anew. Longer words, for which
the scans would grow with the square of their length, use a heap over linked parts; the merges are the same.

Nulls count as empty texts, which have no tokens. Special tokens inside a text become their own ids, as the
tokenizers library does. Repeated rows and ties need no rule, since a row's result is its own, and an empty table
gives an empty result. Extra columns are passed on; a column with the name of a result gives way to it.
"""

from __future__ import annotations

import heapq
import json
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.common import slices, texts_of, with_input

#: Words of more parts than this use the heap.
SHORT = 64
#: Words whose ids a task remembers, about 50 MB.
CACHE_WORDS = 200_000
_NONE = 1 << 60
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class RankBpe:
    def __init__(self, spec: str):
        parts = json.loads(spec)
        vocab, letters = parts["model"]["vocab"], byte_letters()
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if all(c in letters for c in token)}
        self.special = {x["content"]: x["id"] for x in parts["added_tokens"]}
        self.bytes_of |= {i: x.encode() for x, i in self.special.items()}
        by_bytes = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        self.single = [by_bytes[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(parts["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.words = regex.compile(_WORDS)
        self.splits = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def _rank(self, a: int, b: int) -> int:
        return self.pairs.get((a, b), (_NONE, 0))[0]

    def _short(self, ids: list[int]) -> list[int]:
        ranks = [self._rank(a, b) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) < _NONE:
            i = ranks.index(least)
            ids[i : i + 2] = [self.pairs[ids[i], ids[i + 1]][1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = self._rank(ids[i], ids[i + 1])
            if i:
                ranks[i - 1] = self._rank(ids[i - 1], ids[i])
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self._rank(ids[i], ids[i + 1])) < _NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := self._rank(ids[k], ids[after[k]])) < _NONE:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return [x for x in ids if x >= 0]

    def word(self, word: str) -> list[int]:
        ids = [self.single[b] for b in word.encode()]
        return self._short(ids) if len(ids) <= SHORT else self._long(ids)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        out = []
        for piece in self.splits.split(text) if self.splits else [text]:
            if piece in self.special:
                out.append(array("I", [self.special[piece]]).tobytes())
                continue
            words = self.words.findall(piece)
            try:
                out += [self.cache[w] for w in words]
                continue
            except KeyError:
                pass
            for w in words:
                if (known := self.cache.get(w)) is None:
                    known = array("I", self.word(w)).tobytes()
                    if len(w) <= SHORT:
                        if len(self.cache) >= CACHE_WORDS:
                            self.cache.clear()
                        self.cache[w] = known
                out.append(known)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@lru_cache(1)
def tokenizer(spec: str) -> RankBpe:
    """One per Python worker; spec: the text of a tokenizer's JSON file."""
    return RankBpe(spec)


def read_spec(path: str) -> str:
    """A tokenizer's JSON file, read on the driver: a few MB whatever the corpus is."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, to: str = "token_ids") -> DataFrame:
    """df's columns `keep` (all by default) and the column `to` (little-endian unsigned 32-bit integers, packed)."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != to.lower()]
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    rows, at = with_input(df, keep, text)
    schema = df.limit(0).select(*[F.col(f"`{c}`") for c in keep], F.lit(b"").alias(to)).schema

    def run(batches):
        own = tokenizer(spec.value)
        for batch in slices(batches, at):
            ids = pa.array([own.encode(x) for x in texts_of(batch.column(at))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids], names=[*keep, to])

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """df with the texts of packed token ids in the column `to`; null ids give a null."""
    keep = [c for c in df.columns if c.lower() != to.lower()]
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    rows, at = with_input(df, keep, ids)
    schema = df.limit(0).select(*[F.col(f"`{c}`") for c in keep], F.lit("").alias(to)).schema

    def run(batches):
        own = tokenizer(spec.value)
        for batch in slices(batches, at):
            texts = pa.array([None if x is None else own.decode(x) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], names=[*keep, to])

    return rows.mapInArrow(run, schema)
