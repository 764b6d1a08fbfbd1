"""Secret scans that link the parts of a credential.

Strong patterns (assignments of passwords and the like, access keys, long hexadecimal strings) are always reported. Weak
patterns name one part of a credential each: an access identifier (`user`), a secret (`value`) or an endpoint
(`endpoint`); alone they are too common to report. A text falls into scopes, which blank lines part. Within a scope each
part is an interval, widened by REACH characters on both sides and cut at the scope's ends, and is joined with the parts of
other roles that it overlaps: a binary search over the sorted starts and ends of each role. Every pattern has a weight. A
weak candidate is reported only where complementary parts are near: a secret needs an identifier or an endpoint, an
identifier or an endpoint needs a secret, and the weights of the candidate and of the heaviest part of each other role near
it must be LEAST together. A weak candidate that overlaps a strong span of its role adds nothing and is dropped before.

Places are code points, ends exclusive. Null and empty texts have no spans. Repeated rows get equal results; extra columns
are passed on, whatever their names are; an empty table gives an empty result. Texts are scanned where they are read,
without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from roundhouse.llm.common import slices, texts_of, unused, with_input

USER, SECRET, ENDPOINT = "user", "secret", "endpoint"
REACH = 200
LEAST = 3


def either_case(pattern: str) -> str:
    """The pattern with each ASCII letter outside of brackets and escapes in either case: the same for all engines."""
    return "".join(x if len(x) > 1 or not x.isalpha() else f"[{x.upper()}{x.lower()}]" for x in re.findall(r"\[[^\]]*\]|\\x..|\\.|\(\?:|.", pattern, re.DOTALL))


_ASSIGN = r"""["']?\x20*[:=]\x20*["']?"""


class Kind(NamedTuple):
    """strong kinds are reported anywhere; group, if any, must have `least` characters, else the whole match."""

    name: str
    role: str
    weight: int
    strong: bool
    pattern: str
    group: int
    least: int


KINDS = (
    Kind("assign", SECRET, 2, True, either_case("(password|passwd|secret|token|api_?key)") + _ASSIGN + "([A-Za-z0-9+/_.=-]+)", 2, 6),
    Kind("access", USER, 2, True, "AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", SECRET, 1, True, "[0-9a-f]{24,}", 0, 24),  # whole runs, as every match begins at the first character of one
    Kind("user", USER, 1, False, either_case("(user|user_?name|login|account|client_?id|access_?key_?id)") + _ASSIGN + "([A-Za-z0-9._@+-]+)", 2, 3),
    Kind("mail", USER, 1, False, r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+", 0, 6),
    Kind("value", SECRET, 1, False, either_case("(pass|pwd|passphrase|auth|private_?key|access_?key|credentials?)") + _ASSIGN + "([A-Za-z0-9+/_.=-]+)", 2, 6),
    Kind("blob", SECRET, 1, False, "[A-Za-z0-9+/]{40,}", 0, 40),
    Kind("url", ENDPOINT, 1, False, "(https?|s?ftp|ssh|s3|amqps?|redis|mongodb|mysql|postgres|postgresql)://[A-Za-z0-9.-]+(:[0-9]+)?", 0, 8),
    Kind("host", ENDPOINT, 1, False, either_case("(host|host_?name|server|endpoint|region|bucket|database)") + _ASSIGN + "([A-Za-z0-9._:/-]+)", 2, 3),
)
#: What parts scopes: a line without anything but blanks.
BLANK_LINE = r"\n[\x20\t\r]*\n"
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("linked", BooleanType())]))


def matches(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that don't overlap; those that are too short are dropped, but take up their place."""
    for m in _compiled(kind.pattern).finditer(text):
        if m.end(kind.group) - m.start(kind.group) >= kind.least:
            yield m.span()


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)  # kept by re


class Intervals:
    """Intervals of one role and weight, asked for overlaps."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts = np.sort(np.array([a for a, _ in spans], np.int64))
        self.ends = np.sort(np.array([b for _, b in spans], np.int64))

    def overlap(self, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Whether any interval overlaps [low, high): more have begun before its end than have ended by its start."""
        return np.searchsorted(self.starts, highs, side="left") > np.searchsorted(self.ends, lows, side="right")


def linked(candidates: list[tuple[Kind, int, int]], strong: list[tuple[Kind, int, int]], blanks: list[tuple[int, int]], reach: int, least: int) -> list[tuple[Kind, int, int]]:
    """The weak candidates that complementary parts are near."""
    own = {role: Intervals([(a, b) for k, a, b in strong if k.role == role]) for role in (USER, SECRET, ENDPOINT)}
    weak = []
    for role, known in own.items():
        rows = [x for x in candidates if x[0].role == role]
        begin, end = (np.array([x[k] for x in rows], np.int64) for k in (1, 2))
        weak += [x for x, hit in zip(rows, known.overlap(begin, end), strict=True) if not hit]
    if not weak:
        return []
    parts = [*strong, *weak]
    by_weight = {(role, w): Intervals([(a, b) for k, a, b in parts if k.role == role and k.weight == w]) for role in own for w in (1, 2)}
    begin, end = (np.array([x[k] for x in weak], np.int64) for k in (1, 2))
    # a scope ends where a blank line begins, and the next one begins where that ends
    closes = np.array([*[a for a, _ in blanks], np.iinfo(np.int64).max])
    opens = np.array([0, *[b for _, b in blanks]])
    scope = np.searchsorted(closes, begin, side="right")
    lows, highs = np.maximum(opens[scope], begin - reach), np.minimum(closes[scope], end + reach)
    near = {role: np.where(by_weight[role, 2].overlap(lows, highs), 2, by_weight[role, 1].overlap(lows, highs).astype(int)) for role in own}
    out = []
    for i, (kind, a, b) in enumerate(weak):
        others = [role for role in own if role != kind.role]
        complete = any(near[role][i] for role in others) if kind.role == SECRET else near[SECRET][i] > 0
        if complete and kind.weight + sum(near[role][i] for role in others) >= least:
            out.append((kind, a, b))
    return out


def spans_of(text: str, reach: int = REACH, least: int = LEAST) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, linked) of all spans to report, by start and then kind as listed."""
    found = [(kind, a, b) for kind in KINDS if kind.strong for a, b in matches(kind, text)]
    out = [(kind, a, b, False) for kind, a, b in found]
    weak = lambda secret: [(kind, a, b) for kind in KINDS if not kind.strong and (kind.role == SECRET) == secret for a, b in matches(kind, text)]
    candidates = weak(True)
    if candidates or any(kind.role == SECRET for kind, _, _ in found):  # every link has a secret
        candidates += weak(False)
    if candidates:
        blanks = [m.span() for m in _compiled(BLANK_LINE).finditer(text)]
        out += [(*x, True) for x in linked(candidates, found, blanks, reach, least)]
    out.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [(kind.name, a, b, hit) for kind, a, b, hit in out]


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None, reach: int = REACH, least: int = LEAST) -> DataFrame:
    """df's columns `keep` (all unless given) and spans, an array of (kind, start, end, linked), called _spans where df has a column spans."""
    keep = list(df.columns) if keep is None else keep
    rows, at = with_input(df, keep, text)
    name = unused("spans", keep)
    schema = StructType([rows.schema[k] for k in range(len(keep))]).add(name, SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("linked", pa.bool_())]))

    def find(batches):
        for batch in slices(batches, at):
            found = [[dict(zip(("kind", "start", "end", "linked"), x, strict=True)) for x in spans_of(t, reach, least)] for t in texts_of(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(found, kind)], names=schema.names)

    return rows.mapInArrow(find, schema)


def digests(scanned: DataFrame, spans: str = "spans") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (text) of scanned documents."""
    told = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = [k.name for k in KINDS if k.strong]
    count = lambda name: F.size(F.filter(spans, lambda x: x["kind"] == name)).cast("long").alias(f"n_{name}")
    own = F.array_join(F.transform(F.filter(spans, lambda x: x["kind"].isin(base)), told), ",")
    return scanned.select("doc_id", *map(count, base), F.sha2(own, 256).alias("base_sha256"), F.array_join(F.transform(spans, told), ",").alias("spans"))
