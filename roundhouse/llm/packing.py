"""Packing documents into training sequences by non-negative least squares.

A document's ids and one end id are cut into full windows, each a sequence of its own, and a remainder. For
the remainders of a pack (PACK_ROWS documents of one task), pairs and triples of lengths that fill a window
exactly are enumerated, their repeat counts are solved against the histogram of lengths by non-negative least
squares and rounded, and what is left is packed greedily: longest first, cut where a window is full. The tail
of a pack is cut at powers of two, so no sequence needs padding.

Packs are made inside the tasks that read the documents: no shuffle, and a lost task is simply run again.
Nulls count as empty texts: they have the end id alone. Repeated rows are packed each; extra columns are
passed over; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.bpe import RankBpe, read_spec, tokenizer
from roundhouse.llm.common import slices, small_batches, texts_of

WINDOW, END_ID = 2048, 1
#: Documents whose remainders are packed together: at most 64 MB of ids.
PACK_ROWS = 8192
#: Columns of the least squares: combinations of lengths that are tried for a pack.
COLUMNS = 6000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(1)
def encoder(spec: str):
    """Text -> list of ids. A byte-level vocabulary whose ids follow its merges can run on tiktoken's loop; texts that it refuses are encoded as in op8.

    Of the tables of op8 nothing is kept beside tiktoken's, until a text needs them.
    """
    own = RankBpe(spec)
    merged = [i for _, i in sorted(own.pairs.values())]
    if merged != sorted(merged):
        return lambda text: np.frombuffer(own.encode(text), np.uint32).tolist()
    import tiktoken

    ranks = {b: i for i, b in own.bytes_of.items() if i not in own.special.values()}
    fast = tiktoken.Encoding("own", pat_str=own.words.pattern.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S"), mergeable_ranks=ranks, special_tokens=own.special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:  # its regex engine gives up on a run of about a million white-space characters
            return np.frombuffer(tokenizer(spec).encode(text), np.uint32).tolist()

    return encode


def combinations(lengths: np.ndarray, most: int = COLUMNS, window: int = WINDOW) -> np.ndarray:
    """Rows of two or three of the given sorted lengths (0: none) that add up to a window; every pair, and triples up to `most` rows."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    pairs = [(a, window - a, 0) for a in lengths.tolist() if a <= window - a and have[window - a]]
    triples: list[tuple[int, int, int]] = []
    for step in range(len(lengths)):
        if len(pairs) + len(triples) >= most:
            break
        first, second = lengths[: len(lengths) - step], lengths[step:]
        third = window - first - second
        fits = third >= second
        fits[fits] = have[third[fits]]
        triples += zip(first[fits].tolist(), second[fits].tolist(), third[fits].tolist(), strict=True)
    return np.array([*pairs, *triples[: max(0, most - len(pairs))]], np.int64).reshape(-1, 3)


def repeat_counts(rows: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """min |A x - h|^2 over x >= 0 by multiplicative updates; column k of A counts the lengths of rows[k]."""

    def apply(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(rows[:, k], weights=x, minlength=len(histogram)) for k in range(3))
        out[0] = 0
        return out

    def back(y: np.ndarray) -> np.ndarray:
        return y[rows].sum(1)

    want = histogram.astype(float)
    want[0] = 0
    x = np.minimum.reduce([np.where(rows[:, k] > 0, want[rows[:, k]], np.inf) for k in range(3)]) / 3
    target = back(want)
    for _ in range(rounds):
        x *= target / np.maximum(back(apply(x)), 1e-12)
    return x


class Pack:
    """Remainders of one pack: (doc_id, start, ids as bytes, tokens of the document)."""

    def __init__(self):
        self.by_length: dict[int, list[tuple]] = defaultdict(list)
        self.rows = 0

    def add(self, doc_id, start: int, ids: bytes, tokens: int) -> None:
        self.by_length[len(ids) // 4].append((doc_id, start, ids, tokens))

    def sequences(self, columns: int = COLUMNS):
        """Lists of (doc_id, start, ids, tokens), one list per sequence. Nothing is left out: what the columns don't place is packed greedily."""
        queue = self.by_length
        lengths = np.array(sorted(k for k in queue if k), np.int64)
        histogram = np.zeros(WINDOW + 1, np.int64)
        histogram[lengths] = [len(queue[k]) for k in lengths.tolist()]
        rows = combinations(lengths, columns)
        if len(rows):
            counts = repeat_counts(rows, histogram)
            for k in np.argsort(-counts, kind="stable").tolist():
                need = [x for x in rows[k].tolist() if x]
                for _ in range(int(counts[k] + 0.5)):
                    if any(len(queue[x]) < need.count(x) for x in need):
                        break
                    yield [queue[x].pop() for x in need]
        rest = [x for k in sorted(queue, reverse=True) for x in queue[k]]
        current: list[tuple] = []
        room = WINDOW
        for doc_id, start, ids, tokens in rest:
            while ids:
                head = ids[: 4 * room]
                current.append((doc_id, start, head, tokens))
                start, ids, room = start + len(head) // 4, ids[4 * room :], room - len(head) // 4
                if not room:
                    yield current
                    current, room = [], WINDOW
        yield from tail(current)


def tail(pieces: list[tuple]):
    """The pieces, cut into sequences whose lengths are powers of two."""
    left = sum(len(x[2]) // 4 for x in pieces)
    pieces = pieces[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        out = []
        while size:
            doc_id, start, ids, tokens = pieces.pop()
            head, rest = ids[: 4 * size], ids[4 * size :]
            out.append((doc_id, start, head, tokens))
            size -= len(head) // 4
            if rest:
                pieces.append((doc_id, start + len(head) // 4, rest, tokens))
        yield out


def pack_rows(batches, encode, partition: int, pack_rows: int = PACK_ROWS, columns: int = COLUMNS):
    """Lists of piece rows, from batches of (doc_id, text)."""
    number = partition << 40
    pack = Pack()
    for ids, texts in batches:
        out = []
        for doc_id, text in zip(ids, texts, strict=True):
            tokens = np.array([*encode(text), END_ID], np.uint32)
            data, n = tokens.tobytes(), len(tokens)
            full = n - n % WINDOW
            for start in range(0, full, WINDOW):
                out.append((doc_id, start, WINDOW, zlib.crc32(data[4 * start : 4 * (start + WINDOW)]), n, number, 0))
                number += 1
            if full < n:
                pack.add(doc_id, full, data[4 * full :], n)
            pack.rows += 1
            if pack.rows >= pack_rows:
                number = placed(pack, number, out, columns)
                pack = Pack()
        yield out
    out = []
    placed(pack, number, out, columns)
    yield out


def placed(pack: Pack, number: int, out: list[tuple], columns: int) -> int:
    for sequence in pack.sequences(columns):
        offset = 0
        for doc_id, start, ids, tokens in sequence:
            out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), tokens, number, offset))
            offset += len(ids) // 4
        number += 1
    return number


def pack(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", columns: int = COLUMNS) -> DataFrame:
    """One row per piece: PIECES. sequence_id is unique over all tasks. columns: combinations of lengths that the least squares of a pack weigh, at most."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    schema = PIECES
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches):
        pairs = ((b.column(0).to_pylist(), texts_of(b.column(1))) for b in slices(batches, 1))
        for rows in pack_rows(pairs, encoder(spec.value), TaskContext.get().partitionId(), columns=columns):
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names))], names=names)

    return small_batches(df).select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")).mapInArrow(run, schema)
