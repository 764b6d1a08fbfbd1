"""Chat formatting with loss masks aligned by offsets.

A whole conversation is rendered once: <|im_start|>role<|im_sep|>text<|im_end|> for each turn. The three marks
are special tokens of the encoder, so no token straddles a text's border. Inside roles and texts a backslash
becomes two and "<|" becomes "<\\|", which no mark contains; reading back undoes that. The rendered
conversation is encoded once with offsets, and the turns' spans are intersected with the tokens' spans by
binary search: tokens inside the texts of the trained roles carry the loss.

Rows are ordered by turn; rows with equal turns by role and text, so ties give one result. Null roles and
texts count as empty, a null conv_id is a conversation of its own, and repeated rows are turns each. Extra
columns are passed over; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.bpe import read_spec
from roundhouse.llm.common import small_batches

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
FORMATTED = "conv_id long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\\|])", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the code point span of each turn's text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role)}{SEP}"
        body = escape(text)
        out += [head, body, END]
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    found = re.findall(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), formatted, re.DOTALL)
    return [(unescape(role), unescape(text)) for role, text in found]


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the sorted spans: the last span that starts at or before a token must reach its end."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans, np.int64).T
    at = np.searchsorted(first, starts, side="right") - 1
    return (at >= 0) & (ends <= last[np.maximum(at, 0)]) & (ends > starts)


def under_loss(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """The unescaped text under the mask, a slice per run of masked tokens: tokens that share a code point cover it once."""
    edge = np.diff(np.concatenate([[0], loss.astype(np.int8), [0]]))
    runs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
    return unescape("".join(formatted[starts[a] : ends[b - 1]] for a, b in runs))


@lru_cache(2)
def encoder(spec: str):
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(spec)
    own.no_padding()
    own.no_truncation()
    own.add_special_tokens([START, SEP, END])
    return own


def format_conversations(df: DataFrame, path: str, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conv_id: FORMATTED. df has conv_id, turn, role and text."""
    spec = df.sparkSession.sparkContext.broadcast(read_spec(path))
    turns = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    grouped = small_batches(df).groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(turns.alias("turns"))

    def run(batches):
        own = encoder(spec.value)
        for batch in batches:
            rows = []
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                formatted, spans = render([(x["role"], x["text"]) for x in turns])
                encoded = own.encode(formatted, add_special_tokens=False)
                starts, ends = np.array(encoded.offsets, np.int64).reshape(-1, 2).T
                loss = mask(starts, ends, [s for s, x in zip(spans, turns, strict=True) if x["role"] in trained])
                rows.append((conv_id, formatted, encoded.ids, starts, ends, loss))
            places = pa.array(np.cumsum([0, *[len(r[2]) for r in rows]]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(places, pa.array(np.concatenate([np.zeros(0, kind), *[r[k] for r in rows]]).astype(kind))) for k, kind in ((2, np.int32), (3, np.int32), (4, np.int32), (5, bool))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), *lists], names=[x.split()[0] for x in FORMATTED.split(", ")])

    return grouped.mapInArrow(run, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What the outputs of format_conversations say, read back from them alone."""
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        for batch in batches:
            rows = []
            values = [batch.column(k).values.to_numpy(zero_copy_only=False) for k in (2, 3, 4)]
            places = batch.column(2).offsets.to_pylist()
            for conv_id, text, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), places, places[1:], strict=False):
                turns, under = read_back(text), under_loss(text, *[v[a:b] for v in values])
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], x) for k, x in enumerate(kinds)], names=[x.split()[0] for x in kind.split(", ")])

    return formatted.select("conv_id", "formatted", "token_starts", "token_ends", "loss_mask").mapInArrow(run, kind)
