"""Ordered operators: windows over frames, folds over short arrays, and sequential state per round."""

from __future__ import annotations

import math
from collections import deque
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators.joins import FRAME_BUCKET, asof_offset, chunk_slices, interval_overlap_join, point_in_interval_join
from roundhouse.operators.picks import random_key
from roundhouse.storage import forget, stored

#: Intervals of a stretch that are folded as one array, 100 kB.
LONG_STRETCH = 4096


def merge_chunks(rounds: DataFrame, chunks: DataFrame, gap_preserving: bool = False) -> DataFrame:
    """Frames of every round from its chunks: frame_id counts what is there, or (gap_preserving) keeps the distance to the round's start."""
    s = chunk_slices(rounds, chunks)
    rows = s.select("round_id", "lo", "chunk_start", F.explode(F.sequence("slice_from", F.col("slice_to") - 1)).alias("pos"))
    if gap_preserving:
        return rows.withColumn("frame_id", F.col("chunk_start") + F.col("pos") - F.col("lo"))
    # a chunk's frames follow those of the chunks before it: a running sum over chunks, not a sort of all frames
    order = Window.partitionBy("round_id").orderBy("chunk_start").rowsBetween(Window.unboundedPreceding, -1)
    before = s.withColumn("__before", F.coalesce(F.sum(F.col("slice_to") - F.col("slice_from")).over(order), F.lit(0)))
    rows = before.select("round_id", "lo", "chunk_start", "slice_from", "__before", F.explode(F.sequence("slice_from", F.col("slice_to") - 1)).alias("pos"))
    return rows.withColumn("frame_id", (F.col("__before") + F.col("pos") - F.col("slice_from")).cast("int")).select("round_id", "lo", "chunk_start", "pos", "frame_id")


def tap_motion(segs: DataFrame, kps: DataFrame, table_y: float = 480 / 720, dip: float = 0.02) -> DataFrame:
    """Per segment the largest tap: a fingertip's first local peak (y grows towards the table) that stands `dip` over the lowest point before and after it.

    Only samples on the table count and their neighbours are joined; a fingertip with a missing frame is left out. Ties go to the lower hand, then tip.
    """
    key = ["round_id", "seg_id", "hand", "kp"]
    rows = segs.select("round_id", "seg_id", "start_frame", "end_frame").join(kps.where("kp <> 0"), "round_id").where(F.col("frame_id").between(F.col("start_frame"), F.col("end_frame")))
    whole = Window.partitionBy(*key)
    order = whole.orderBy("frame_id")  # also for what needs no order: so the rows are put in order once
    rows = rows.withColumn("n_frames", F.count("*").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).where(F.col("n_frames") == F.col("end_frame") - F.col("start_frame") + 1)
    rows = rows.where((F.col("y") >= table_y) & (F.col("n_frames") >= 3))
    rows = rows.withColumns(
        {
            "prev": F.lag("y").over(order), "next": F.lead("y").over(order),
            "low_before": F.min("y").over(order.rowsBetween(Window.unboundedPreceding, -1)),
            "low_after": F.min("y").over(order.rowsBetween(1, Window.unboundedFollowing)),
            "range": F.max("y").over(whole) - F.min("y").over(whole),
        }
    )
    y = F.col("y")
    peak = (F.col("range") >= dip) & (y >= F.col("prev")) & (y >= F.col("next")) & (y - F.col("low_before") >= dip) & (y - F.col("low_after") >= dip)
    first = rows.where(peak).groupBy(*key).agg(F.min(F.struct("frame_id", "x", "y", ((y - F.col("low_before")) + (y - F.col("low_after"))).alias("dip"))).alias("p"))
    best = first.groupBy("round_id", "seg_id").agg(F.min(F.struct((-F.col("p.dip")).alias("d"), "hand", "kp", "p")).alias("b"))
    return best.select("round_id", "seg_id", F.col("b.p.frame_id").alias("tap_frame"), "b.hand", "b.kp", (F.col("b.p.x") * 1280).alias("tap_x"), (F.col("b.p.y") * 720).alias("tap_y"), (-F.col("b.d")).alias("dip"))


def rolling_median_spread(df: DataFrame, keys: list[str], order: list[str], value: str, width: int = 5) -> DataFrame:
    """Per group ceil(max - min) of the medians of `width` neighbouring values; groups with fewer rows have none."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("__w", F.collect_list(value).over(w.rowsBetween(0, width - 1))).where(F.size("__w") == width)
    rows = rows.withColumn("__m", F.get(F.array_sort("__w"), F.lit(width // 2)))
    return rows.groupBy(*keys).agg(F.ceil(F.max("__m") - F.min("__m")).cast("int").alias("spread"), F.count("*").alias("n_windows"))


def _nearest(rows: list[tuple], begin: int, end: int, place: tuple[float, float], limit: float, suit: tuple = (), but: int = -1) -> int:
    """Which of the cards rows[begin:end] (of that suit, if one is given; not `but`) is nearest a place, -1 beyond the limit; ties go to the earlier one."""
    best, far = -1, math.inf
    for k in range(begin, end):
        row = rows[k]
        if k != but and (not suit or row[4] == suit[0]):
            d = math.hypot(row[2] - place[0], row[3] - place[1])
            if best < 0 or d < far:
                best, far = k, d
    return best if far <= limit else -1


def followed_to(head: tuple, rows: list[tuple], limit: float = 60.0) -> tuple:
    """As followed, and the places in rows of the end's two cards (None: too few frames).

    head: s_ax, s_ay, s_bx, s_by, s_asuit, s_bsuit. rows: frame_id, det_id, cx, cy, suit of the cards of the pair's rank, in order.
    """
    one, two, suits = head[:2], head[2:4], head[4:]
    by_suit = suits[0] != suits[1] and "U" not in suits and "" not in suits
    first, second = (suits[:1], suits[1:]) if by_suit else ((), ())
    seen, end = [], 0
    while end < len(rows):
        begin, frame = end, rows[end][0]
        while end < len(rows) and rows[end][0] == frame:
            end += 1
        if end - begin < 2:
            continue
        a = _nearest(rows, begin, end, one, limit, first)
        b = _nearest(rows, begin, end, two, limit, second, -1 if by_suit else a) if a >= 0 else -1
        if b >= 0:
            one, two = rows[a][2:4], rows[b][2:4]
            seen.append((frame, math.hypot(one[0] - two[0], one[1] - two[1]), a, b))
    if len(seen) < 5:
        return len(seen), -1, None, None, None, None, None, None
    d = [x[1] for x in seen]
    medians = [sorted(d[k : k + 5])[2] for k in range(len(d) - 4)]
    best = max(seen, key=lambda x: x[1])
    return len(seen), math.ceil(max(medians) - min(medians)), best[0], rows[best[2]][1], rows[best[3]][1], best[1], best[2], best[3]


def followed(head: tuple, rows: list[tuple], limit: float = 60.0) -> tuple:
    """n, spread, end_frame, end_a, end_b and max_distance of one candidate pair; see track_pair and, for head and rows, followed_to."""
    return followed_to(head, rows, limit)[:6]


def follow_pair(pdf: pd.DataFrame, limit: float = 60.0) -> pd.DataFrame:
    """One candidate pair and its frames' cards, in any order and of any rank, as a pandas frame."""
    head = pdf.iloc[0]
    own = pdf[pdf["rank_norm"] == head["pair_rank"]].sort_values(["frame_id", "det_id"])
    rows = list(zip(*(own[c].tolist() for c in ("frame_id", "det_id", "cx", "cy", "suit")), strict=True))
    out = followed(tuple(head[["s_ax", "s_ay", "s_bx", "s_by", "s_asuit", "s_bsuit"]]), rows, limit)
    return pd.DataFrame([(*head[["round_id", "seg_id", "pair_no"]], *out)], columns=["round_id", "seg_id", "pair_no", "n", "spread", "end_frame", "end_a", "end_b", "max_distance"])


TRACKED = "round_id long, seg_id long, pair_no int, n long, spread int, end_frame int, end_a long, end_b long, max_distance double"
#: The cards of the end, if asked for.
END_CARDS = "eax double, eay double, ea_suit string, ebx double, eby double, eb_suit string"
#: Pairs of a batch that goes back.
PAIRS_OUT = 8192


def paired_cards(dets: DataFrame) -> DataFrame:
    """Cards whose frame holds another one of their normalised rank. The others are in no pair, and track_pair passes over their frames."""
    group = Window.partitionBy("round_id", "frame_id", "rank_norm")
    rows = dets.withColumn("rank_norm", g.norm_rank(F.col("rank"))).where("rank_norm is not null").withColumn("__n", F.count("*").over(group))
    return rows.where("__n > 1").select(*dets.columns)


def track_pair(candidates: DataFrame, dets: DataFrame, ends: bool = False) -> DataFrame:
    """Candidate pairs followed from frame to frame: by suit where the suits differ and are known, else by distance, within 60 px of where each card was last matched.

    candidates: round_id, seg_id, pair_no, pair_rank, start_frame, last_frame, s_ax, s_ay, s_bx, s_by, s_asuit, s_bsuit. Segments are dealt to tasks, where a pair's cards
    follow each other in order; one loop over the Arrow batches holds the cards of the present pair. ends: END_CARDS are added.
    """
    keys, head, card = ["round_id", "seg_id", "pair_no"], ["s_ax", "s_ay", "s_bx", "s_by", "s_asuit", "s_bsuit"], ["frame_id", "det_id", "cx", "cy", "suit"]
    cards = dets.withColumn("rank_norm", g.norm_rank(F.col("rank"))).select("round_id", *card, "rank_norm").where("rank_norm is not null")
    rows = point_in_interval_join(cards, candidates.withColumn("rank_norm", F.col("pair_rank")), ["round_id", "rank_norm"], "frame_id", ("start_frame", "last_frame"))
    rows = rows.select(*keys, *head, *card).repartition("round_id", "seg_id").sortWithinPartitions(*keys, "frame_id", "det_id")
    tracked = f"{TRACKED}, {END_CARDS}" if ends else TRACKED
    names, kinds = zip(*(x.split() for x in tracked.split(", ")), strict=True)
    kinds = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[k] for k in kinds]

    def result(key, start, own):
        *out, a, b = followed_to(start, own)
        if not ends:
            return (*key, *out)
        return (*key, *out, *((None,) * 6 if a is None else own[a][2:5] + own[b][2:5]))

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=list(names))

    def values(column):
        return np.array(column.to_pylist(), object) if column.null_count else column.to_numpy(zero_copy_only=False)

    def follow(batches):
        out, key, start, own = [], None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            # only cards become Python rows; a pair's key and start are read once
            ids = [values(batch.column(k)) for k in range(3)]
            begin = [0, *(np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], 0)) + 1).tolist(), batch.num_rows]
            places = [batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in (11, 12)]
            cards_of = list(zip(values(batch.column(9)).tolist(), values(batch.column(10)).tolist(), *places, batch.column(13).to_pylist(), strict=True))
            for a, z in pairwise(begin):
                pair = tuple(batch.column(k)[a].as_py() for k in range(3))
                if pair == key:
                    own += cards_of[a:z]
                    continue
                if key is not None:
                    out.append(result(key, start, own))
                    if len(out) == PAIRS_OUT:
                        yield batch_of(out)
                        out = []
                key, start, own = pair, tuple(batch.column(k)[a].as_py() for k in range(3, 9)), cards_of[a:z]
        if key is not None:
            out.append(result(key, start, own))
        if out:
            yield batch_of(out)

    return rows.mapInArrow(follow, tracked)


OBSERVED = "round_id long, track_id int, frame_id int, det_id long, cx double, cy double, rank string, suit string, conf double"


class Track:
    """A track of one round. rows: its observations that aren't given out yet; number: its place among the kept ones, once it is known."""

    __slots__ = ("first", "last", "live", "n", "number", "rows", "x", "y")

    def __init__(self, frame: int):
        self.first, self.live, self.n, self.number, self.rows = frame, True, 0, None, []


class Follower:
    """Tracks of a round whose detections come in order; see track_items.

    An observation goes out as soon as its track is long enough and all earlier tracks are decided. A track that is still too short gathers fewer than `least_obs`
    observations or fewer frames than `least_span`, and stays alive for `recency` frames after each: so what is held doesn't grow with the round.
    """

    def __init__(self, reach: float = 35.0, recency: int = 75, least_obs: int = 30, least_span: int = 50):
        self.reach, self.recency, self.least_obs, self.least_span = reach, recency, least_obs, least_span
        self.out: list[tuple[int, tuple]] = []
        self.start()

    def start(self) -> None:
        self.live: list[Track] = []
        self.waiting: deque[Track] = deque()
        self.frame, self.claimed, self.kept = None, set(), 0

    def settle(self) -> None:
        """Number or drop the waiting tracks in order of birth, up to the first that is undecided."""
        while self.waiting:
            t = self.waiting[0]
            if t.n >= self.least_obs and t.last - t.first >= self.least_span:
                t.number, self.kept = self.kept, self.kept + 1
                self.out += [(t.number, row) for row in t.rows]
            elif t.live:
                return
            t.rows = []
            self.waiting.popleft()

    def add(self, frame: int, x: float, y: float, row: tuple) -> None:
        if frame != self.frame:
            self.frame, self.claimed = frame, set()
            for t in self.live:
                t.live = frame - t.last <= self.recency
            self.live = [t for t in self.live if t.live]
            self.settle()
        best, far = None, math.inf
        for t in self.live:
            if t not in self.claimed and (d := math.hypot(x - t.x, y - t.y)) < far:
                best, far = t, d
        if best is not None and far <= self.reach:
            self.claimed.add(best)
        else:
            best = Track(frame)
            self.live.append(best)
            self.waiting.append(best)
        best.x, best.y, best.last, best.n = x, y, frame, best.n + 1
        if best.number is None:
            best.rows.append(row)
        else:
            self.out.append((best.number, row))

    def end(self) -> None:
        """The round has ended."""
        for t in self.live:
            t.live = False
        self.settle()
        self.start()

    def take(self) -> list[tuple[int, tuple]]:
        out, self.out = self.out, []
        return out


def track_items(dets: DataFrame, **how) -> DataFrame:
    """Observations of tracks per round: in a frame, by falling confidence (ties: det_id), a detection takes the nearest live track that is free, else starts one.

    A track born in a frame isn't claimed by it, as its own detection is its only observation there. Rounds are dealt to tasks, where their rows follow each other in
    order; one fold over the Arrow batches holds the live tracks of the present round.
    """
    names = [x.split()[0] for x in OBSERVED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.float64()]
    cast = dict(x.split() for x in OBSERVED.split(", "))
    rows = dets.select(*[F.col(c).cast(cast[c]) for c in names if c != "track_id"])
    rows = rows.repartition("round_id").sortWithinPartitions("round_id", "frame_id", F.desc_nulls_last(F.nanvl("conf", F.lit(None))), "det_id")

    def follow(batches):
        tracks, now = Follower(**how), None

        def batch_of(out):
            columns = [[row[0] for _, row in out], [n for n, _ in out], *[[row[k] for _, row in out] for k in range(1, 8)]]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            places = [batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in (3, 4)]
            for x, y, *row in zip(*places, *batch.to_pydict().values(), strict=True):
                if now is not None and row[0] != now[0]:
                    tracks.end()
                now = row
                tracks.add(row[1], x, y, tuple(row))
            yield batch_of(tracks.take())
        tracks.end()
        yield batch_of(tracks.take())

    return rows.mapInArrow(follow, OBSERVED)


def seat_ordinal(obs: DataFrame, seats: DataFrame, obbs: DataFrame) -> DataFrame:
    """Tracks with a seat, ranked in it by the first frame inside the seat's box (else their first frame), then track_id."""
    rows = obs.join(seats.where("seat_id is not null").select("round_id", "track_id", "seat_id"), ["round_id", "track_id"]).join(obbs, ["round_id", "seat_id"])
    inside = g.point_in_obb(F.col("cx"), F.col("cy"), g.corners())
    return in_order_of_entry(rows.groupBy("round_id", "track_id", "seat_id").agg(F.coalesce(F.min(F.when(inside, F.col("frame_id"))), F.min("frame_id")).alias("entry_frame")))


def in_order_of_entry(t: DataFrame) -> DataFrame:
    """Tracks (round_id, track_id, seat_id, entry_frame), ranked in their seat."""
    order = Window.partitionBy("round_id", "seat_id").orderBy("entry_frame", "track_id")
    return t.withColumn("ordinal", F.row_number().over(order))


def first_reversal(df: DataFrame, keys: list[str], order: str, values: list[str], least: float = 3.0) -> DataFrame:
    """Per group n, its rows, and turn, the place of the first step (of `least` at least) of any of the values against the direction of that value's step before it (null: none).

    All values are followed in one order of the rows, which are put in order once.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.select(*keys, order, *values).withColumns({f"__s_{v}": F.col(v) - F.lag(v).over(w) for v in values})
    way = {v: F.when(F.abs(f"__s_{v}") >= least, F.signum(f"__s_{v}")) for v in values}
    rows = rows.withColumns({f"__p_{v}": F.last(way[v], ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for v in values})
    turned = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"__p_{v}") != way[v], F.lit(False)) for v in values])
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.when(turned, F.col(order))).alias("turn"))


def zigzag(cards: DataFrame, obbs: DataFrame) -> DataFrame:
    """Per seat of three cards or more the ordinal of the first that breaks the line, along the long or the short axis.

    cards: round_id, seat_id, ordinal, cx, cy.
    """
    keys = ["round_id", "seat_id"]
    p = (F.col("cx"), F.col("cy"), g.corners())
    rows = cards.select(*keys, "ordinal", "cx", "cy").where("seat_id > 0").join(obbs, keys).withColumns({"l": g.project_obb(*p, "long"), "s": g.project_obb(*p, "short")})
    return first_reversal(rows, keys, "ordinal", ["l", "s"]).where("n >= 3 and turn is not null").select(*keys, F.col("turn").alias("double_ordinal"))


def fan_double(cards: DataFrame, two_sided: bool = False, least: float = 4.0, sine: float = 0.3) -> DataFrame:
    """Seats whose fan turns: the first step after the second card that is short, or leaves the fan's direction to one side, flags the seat's last card.

    cards: round_id, seat_id, ordinal (1 to n without gaps), cx, cy of one frame.
    """
    keys = ["round_id", "seat_id"]
    w = Window.partitionBy(*keys).orderBy("ordinal")
    rows = cards.where("seat_id > 0").withColumns({"vx": F.col("cx") - F.lag("cx").over(w), "vy": F.col("cy") - F.lag("cy").over(w), "k": F.row_number().over(w)})
    head = rows.where("k = 2").select(*keys, F.col("vx").alias("fx"), F.col("vy").alias("fy"))
    steps = rows.where("k >= 3").join(head, keys)
    lf, lv = F.sqrt(F.col("fx") ** 2 + F.col("fy") ** 2), F.sqrt(F.col("vx") ** 2 + F.col("vy") ** 2)
    turn = F.try_divide(F.col("fx") * F.col("vy") - F.col("fy") * F.col("vx"), lf * lv)
    bad = (lv < least) | ((F.abs(turn) > sine) if two_sided else (turn < -sine))
    hit = steps.where((lf >= least) & bad).groupBy(*keys).agg(F.min("k").alias("turn"))
    last = cards.groupBy(*keys).agg(F.max("ordinal").alias("double_ordinal"))
    return hit.join(last, keys)


def split_seats(cards: DataFrame, obbs: DataFrame, least_cards: int = 3, least_px: float = 25.0, most_degrees: float = 40.0) -> DataFrame:
    """Seats whose first two cards are a pair laid side by side. A first card that is no longer alive is replaced by the next live card of its rank.

    cards: round_id, seat_id, ordinal, rank, cx, cy, alive.
    """
    keys = ["round_id", "seat_id"]
    rows = cards.withColumn("rank_norm", g.norm_rank(F.col("rank"))).where("seat_id > 0")
    card = F.struct("ordinal", "rank_norm", "cx", "cy", "alive")
    seat = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(card)).alias("c")).where(F.size("c") >= least_cards)
    one, two = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    seat = seat.where(one["rank_norm"] == two["rank_norm"])
    spare = F.filter(F.slice("c", F.lit(3), F.size("c")), lambda x: x["alive"] & (x["rank_norm"] == F.get("c", F.lit(0))["rank_norm"]))
    seat = seat.withColumn("spare", spare)
    a = F.when(one["alive"], one).otherwise(F.coalesce(F.get("spare", F.lit(0)), one))
    b = F.when(two["alive"], two).otherwise(F.coalesce(F.when(one["alive"], F.get("spare", F.lit(0))).otherwise(F.get("spare", F.lit(1))), two))
    seat = seat.select(*keys, a.alias("a"), b.alias("b")).join(obbs, keys)
    box = g.corners()
    inside = g.point_in_obb(F.col("a.cx"), F.col("a.cy"), box) & g.point_in_obb(F.col("b.cx"), F.col("b.cy"), box)
    (ax, ay), (bx, by) = g.upright_frame(F.col("a.cx"), F.col("a.cy"), box), g.upright_frame(F.col("b.cx"), F.col("b.cy"), box)
    seat = seat.withColumns({"dx": bx - ax, "dy": by - ay}).where(inside)
    flat = F.degrees(F.atan2(F.abs("dy"), F.abs("dx"))) < most_degrees
    return seat.where((F.sqrt(F.col("dx") ** 2 + F.col("dy") ** 2) >= least_px) & flat).select(*keys, F.col("a.ordinal").alias("first_ordinal"), F.col("b.ordinal").alias("second_ordinal"))


def two_piles(points: np.ndarray, begin: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Pile 1 (left) or 2 of each point, for many groups at once; begin: where each group (of one point or more) starts.

    Two means per group, started at its first points of least and of largest x; a group stops when its means stay. A group of one point is pile 1.
    """
    sizes = np.diff([*begin, len(points)])
    group = np.repeat(np.arange(len(begin)), sizes)
    centre = np.stack([points[_first_least(x, begin, group)] for x in (points[:, 0], -points[:, 0])], 1)  # group, pile, axis
    second = np.zeros(len(points), bool)
    moving = sizes > 1
    for _ in range(rounds):
        if not moving.any():
            break
        far = [np.hypot(*(points - centre[group, k]).T) for k in (0, 1)]
        second = np.where(moving[group], far[1] < far[0], second)
        new = centre.copy()
        for k, own in enumerate((~second, second)):
            n = np.bincount(group, weights=own, minlength=len(begin))
            some = n > 0
            for axis in (0, 1):
                new[some, k, axis] = np.bincount(group, weights=own * points[:, axis], minlength=len(begin))[some] / n[some]
        still = np.isclose(new, centre).all((1, 2))
        centre = np.where((moving & ~still)[:, None, None], new, centre)
        moving &= ~still
    left = centre[:, 0, 0] >= centre[:, 1, 0]
    return np.where((sizes == 1)[group] | (second == left[group]), 1, 2)


def _first_least(value: np.ndarray, begin: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The place of each group's first least value."""
    least = np.minimum.reduceat(value, begin)
    at = np.flatnonzero(value == least[group])
    return at[np.unique(group[at], return_index=True)[1]]


def two_means(cards: DataFrame) -> DataFrame:
    """cards (round_id, seat_id, ordinal, cx, cy) with their pile. A seat's few cards are one row, and a batch of seats is solved together."""
    rows = cards.groupBy("round_id", "seat_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy")))).alias("cards"))
    kind = "round_id long, seat_id int, cards array<struct<ordinal:int,cx:double,cy:double>>, piles array<int>"

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own = batch.column(2)
                points = np.stack([own.flatten().field(k).to_numpy(zero_copy_only=False) for k in (1, 2)], 1)
                ends = np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False))
                piles = two_piles(points, np.concatenate([[0], ends[:-1]]))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(piles.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["round_id", "seat_id", "cards", "piles"])

    out = rows.select(F.col("round_id").cast("long"), F.col("seat_id").cast("int"), F.col("cards").cast("array<struct<ordinal:int,cx:double,cy:double>>")).mapInArrow(run, kind)
    return out.select("round_id", "seat_id", F.explode(F.arrays_zip("cards", "piles")).alias("c")).select("round_id", "seat_id", "c.cards.*", F.col("c.piles").alias("pile"))


def frame_labels(segs: DataFrame, lengths: DataFrame, background: str = "background") -> DataFrame:
    """Dense labels of frames 1 to n of every round (lengths: round_id, n): the first covering segment (seq) that isn't background."""
    lit = segs.where(F.col("label") != background).select("round_id", F.explode(F.sequence(F.greatest("start_frame", F.lit(1)), F.greatest("end_frame", F.lit(1)))).alias("frame_id"), "seq", "label", F.col("end_frame").alias("__e")).where("__e >= 1")
    first = lit.groupBy("round_id", "frame_id").agg(F.min(F.struct("seq", "label"))["label"].alias("label"))
    all_frames = lengths.select("round_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("frame_id"))
    return all_frames.join(first, ["round_id", "frame_id"], "left").withColumn("label", F.coalesce("label", F.lit(background)))


def sample_frames(segs: DataFrame, step: int, last: Column | None = None) -> DataFrame:
    """Every step-th frame of each segment, up to `last`."""
    end = F.col("end_frame") if last is None else F.least("end_frame", last)
    rows = segs.withColumn("__end", end).where("start_frame <= __end")
    return rows.withColumn("frame_id", F.explode(F.sequence("start_frame", "__end", F.lit(step)))).drop("__end")


def _mean_vectors(rows: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """Mean vector per group: whole vectors are summed, map-side first."""
    return rows.groupBy(*keys).agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>")))).alias("vec"))


def segment_mean(segs: DataFrame, feats: DataFrame) -> DataFrame:
    """Mean vector of each segment's frames, both ends inclusive."""
    rows = point_in_interval_join(feats.select("video_id", "frame_idx", "embedding"), segs, ["video_id"], "frame_idx")
    return _mean_vectors(rows, segs.columns, "embedding")


def temporal_bins(units: DataFrame, feats: DataFrame, bins: int) -> DataFrame:
    """Per unit (video_id, start_frame, end_frame, exclusive) the mean vectors of `bins` equal parts, one after another.

    Bin b holds frames floor(b * n / bins) to floor((b + 1) * n / bins) of the unit; an empty bin repeats the one before, an empty first bin is the first frame.
    Bins before the first frame that there is are left out; a unit without any frame has an empty vector.
    """
    key = ["video_id", "start_frame", "end_frame"]
    n = F.col("end_frame") - F.col("start_frame")
    edge = lambda b: F.floor(b * n / bins).cast("int")
    parts = units.select(*key).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumns({"a": edge(F.col("bin")), "z": edge(F.col("bin") + 1)})
    parts = parts.withColumn("z", F.when((F.col("bin") == 0) & (F.col("z") <= F.col("a")), F.col("a") + 1).otherwise(F.col("z")))
    spans = parts.select(*key, "bin", (F.col("start_frame") + F.col("a")).alias("first"), (F.col("start_frame") + F.col("z") - 1).alias("last"))
    rows = point_in_interval_join(feats.select("video_id", "frame_idx", "embedding"), spans, ["video_id"], "frame_idx", ("first", "last"))
    means = _mean_vectors(rows, [*key, "bin"], "embedding")
    order = Window.partitionBy(*key).orderBy("bin")
    filled = parts.select(*key, "bin").join(means, [*key, "bin"], "left").withColumn("vec", F.last("vec", ignorenulls=True).over(order))
    own = F.filter(F.array_sort(F.collect_list(F.struct("bin", "vec"))), lambda x: x["vec"].isNotNull())
    return filled.groupBy(*key).agg(F.flatten(F.transform(own, lambda x: x["vec"])).alias("vec"))


def sliding_windows(lengths: DataFrame, width: int, stride: int) -> DataFrame:
    """Windows [s, s + width) for s = 0, stride and so on while they fit (lengths: keys and n)."""
    rows = lengths.where(F.col("n") >= width)
    rows = rows.withColumn("start_frame", F.explode(F.sequence(F.lit(0), (F.col("n") - width).cast("int"), F.lit(stride))))
    return rows.withColumn("end_frame", F.col("start_frame") + width)


def window_labels(windows: DataFrame, segs: DataFrame, focus: str, width: int, fraction: float = 0.3, other: str = "discard") -> DataFrame:
    """Label of each window: focus if it covers floor(width * fraction) frames, else the label that covers most (ties: first seen), if enough, else `other`.

    Ends count as exclusive here.
    """
    need = int(width * fraction)
    w = windows.select("round_id", F.col("start_frame").alias("ws"), F.col("end_frame").alias("we"))
    hit = interval_overlap_join(w, segs.select("round_id", "seg_id", "label", "start_frame", "end_frame"), ["round_id"], ("ws", "we"), ("start_frame", "end_frame"), bucket=FRAME_BUCKET)
    shared = F.greatest(F.lit(0), F.least("we", "end_frame") - F.greatest("ws", "start_frame"))
    per = hit.withColumn("o", shared).where("o > 0").groupBy("round_id", "ws", "we", "label").agg(F.sum("o").alias("o"), F.min(F.struct("start_frame", "seg_id")).alias("first"))
    best = per.groupBy("round_id", "ws", "we").agg(F.max(F.when(F.col("label") == focus, F.col("o"))).alias("f"), F.min(F.struct((-F.col("o")).alias("o"), "first", "label")).alias("b"))
    label = F.when(F.col("f") >= need, focus).when(-F.col("b.o") >= need, F.col("b.label")).otherwise(other)
    out = w.join(best, ["round_id", "ws", "we"], "left")
    return out.select("round_id", F.col("ws").alias("start_frame"), F.col("we").alias("end_frame"), F.coalesce(F.when(F.col("b").isNotNull(), label), F.lit(other)).alias("label"))


def jitter(segs: DataFrame, copies: int = 3, share: float = 0.15, seed: int = 42, last: Column | None = None) -> DataFrame:
    """Each segment and `copies` copies whose ends move by up to `share` of its length, from md5 hashes of (seed, seg_id, copy); inverted ones go."""
    digits = lambda k: F.conv(F.substring(random_key(["seg_id", "copy"], seed), 1 + 8 * k, 8), 16, 10).cast("long")
    uniform = lambda k: (digits(k) % 2_000_001) / 1_000_000.0 - 1
    length = F.col("end_frame") - F.col("start_frame") + 1
    rows = segs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies))))
    move = lambda c, k: F.when(F.col("copy") == 0, F.col(c)).otherwise((F.col(c) + F.floor(uniform(k) * share * length + 0.5)).cast("int"))
    end = move("end_frame", 1)
    rows = rows.withColumns({"s": F.greatest(F.lit(0), move("start_frame", 0)), "e": end if last is None else F.least(end, last)}).where("s <= e")
    return rows.drop("start_frame", "end_frame").withColumnsRenamed({"s": "start_frame", "e": "end_frame"})


def stretches(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with __stretch: a group's intervals are numbered anew where none of the earlier ones is open any more."""
    by_start = Window.partitionBy(*keys).orderBy("start_frame", "seg_id")
    rows = df.withColumn("__open", F.max("end_frame").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    return rows.withColumn("__stretch", F.count_if(F.col("start_frame") >= F.col("__open")).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__open")


def fold_stretches(rows: DataFrame, keys: list[str], iou: float, topn: int) -> DataFrame:
    """Greedy suppression over each stretch's intervals as one array: keys and k, the interval that stays."""
    item = F.struct((-F.col("score")).alias("neg"), "start_frame", "seg_id", "end_frame")
    rows = rows.groupBy(*keys, "__stretch").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.filter("items", lambda x: F.lit(False))
    clash = lambda x, k: g.interval_iou(x["start_frame"], x["end_frame"], k["start_frame"], k["end_frame"]) > iou
    kept = F.aggregate("items", empty, lambda acc, x: F.when((F.size(acc) >= topn) | F.exists(acc, lambda k: clash(x, k)), acc).otherwise(F.concat(acc, F.array(x))))
    return rows.select(*keys, F.explode(kept).alias("k"))


def dominance(items: DataFrame, keys: list[str], iou: float, bucket: int = FRAME_BUCKET) -> DataFrame:
    """(winner, loser), numbers __id of items: the first is better and the two overlap by more than iou."""
    side = lambda p: items.select(*keys, F.col("__id").alias(f"{p}_id"), F.col("start_frame").alias(f"{p}_s"), F.col("end_frame").alias(f"{p}_e"), F.struct((-F.col("score")).alias("neg"), "start_frame", "seg_id", "__id").alias(p))
    pairs = interval_overlap_join(side("a"), side("b"), keys, ("a_s", "a_e"), ("b_s", "b_e"), bucket=bucket).where("a < b")
    return pairs.where(g.interval_iou(F.col("a_s"), F.col("a_e"), F.col("b_s"), F.col("b_e")) > iou).select(F.col("a_id").alias("winner"), F.col("b_id").alias("loser"))


def suppress_by_rounds(rows: DataFrame, keys: list[str], iou: float) -> DataFrame:
    """The intervals that greedy suppression leaves, by rounds of local maxima: one that is better than all it clashes with stays, and those go.

    What neither stays nor goes takes part in the next round; the rounds are few where scores aren't sorted along the frames, and each shrinks the table of clashes.
    Of equal intervals only the best takes part.
    """
    best = Window.partitionBy(*keys, "start_frame", "end_frame").orderBy(F.asc_nulls_first(-F.col("score")), "seg_id")
    if iou < 1:
        rows = rows.withColumn("__n", F.row_number().over(best)).where("__n = 1 or start_frame >= end_frame").drop("__n")
    items = stored(rows.withColumn("__id", F.monotonically_increasing_id()), "nms-items")
    clashes, gone = stored(dominance(items, keys, iou), "nms-clashes"), []
    while not clashes.isEmpty():
        stay = clashes.select("winner").distinct().join(clashes.select(F.col("loser").alias("winner")).distinct(), "winner", "left_anti")
        lost = stored(clashes.join(stay, "winner", "left_semi").select("loser").distinct(), "nms-lost")
        left = clashes.join(lost, "loser", "left_anti").join(lost.withColumnRenamed("loser", "winner"), "winner", "left_anti")
        left = stored(left.select("winner", "loser"), "nms-clashes")
        forget(clashes)
        clashes, gone = left, [*gone, lost]
    lost = reduce(DataFrame.unionByName, gone) if gone else clashes.select("loser")
    return items.join(lost.withColumnRenamed("loser", "__id"), "__id", "left_anti").drop("__id")


def nms_1d(df: DataFrame, keys: list[str], iou: float = 0.3, topn: int = 10, most: int = LONG_STRETCH) -> DataFrame:
    """Greedy suppression per group: by falling score (ties: start, then seg_id) an interval stays if it overlaps none that stayed by more than `iou` (0 or more); at most topn stay.

    Only intervals that overlap affect each other: a group is cut where none is open. The fold runs over a stretch's intervals as one array if it has `most` at most; longer
    ones go by rounds of local maxima over bucketed joins (groups with a null key have no such). The first topn of all stretches stay.
    """
    rows = stretches(df.select(*keys, "seg_id", "start_frame", "end_frame", "score"), keys)
    long = rows.groupBy(*keys, "__stretch").agg(F.count("*").alias("__n")).where(F.col("__n") > most).where(" and ".join(f"`{k}` is not null" for k in keys)).select(*keys, "__stretch")
    long = stored(long, "nms-long")
    if long.isEmpty():
        kept = fold_stretches(rows, keys, iou, topn)
    else:
        many = rows.join(long, [*keys, "__stretch"], "left_semi")
        item = F.struct((-F.col("score")).alias("neg"), "start_frame", "seg_id", "end_frame")
        kept = suppress_by_rounds(many, keys, iou).select(*keys, item.alias("k"))
        same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(long[c]) for c in [*keys, "__stretch"]])
        kept = kept.unionByName(fold_stretches(rows.join(long, same, "left_anti"), keys, iou, topn))
    best = Window.partitionBy(*keys).orderBy("k.neg", "k.start_frame", "k.seg_id")
    rows = kept.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < topn)
    return rows.select(*keys, "place", "k.seg_id", "k.start_frame", "k.end_frame", (-F.col("k.neg")).alias("score"))


def dedup_spatial(dets: DataFrame, px: float = 20.0) -> DataFrame:
    """Per frame and (rank, suit), by falling confidence (ties: det_id), a detection stays if it is `px` or more from all that stayed."""
    item = F.struct((-F.col("conf")).alias("neg"), "det_id", "cx", "cy")
    rows = dets.where("cx is not null and cy is not null").groupBy("round_id", "frame_id", "rank", "suit").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.filter("items", lambda x: F.lit(False))
    kept = F.aggregate("items", empty, lambda acc, x: F.when(F.exists(acc, lambda k: g.distance(x["cx"], x["cy"], k["cx"], k["cy"]) < px), acc).otherwise(F.concat(acc, F.array(x))))
    return rows.select("round_id", "frame_id", "rank", "suit", F.explode(kept).alias("k")).select("round_id", "frame_id", "k.det_id", "k.cx", "k.cy", "rank", "suit", (-F.col("k.neg")).alias("conf"))


def count_increased(segs: DataFrame, dets: DataFrame, zone: Column, limit: int = 9) -> DataFrame:
    """segs with the zone's counts at the frames nearest the start and the end (-1: none within the limit) and rejected, if the end has more."""
    counts = dets.groupBy("round_id", "frame_id").agg(F.count_if(zone).alias("n"))
    out = segs
    for name, at in (("start_count", "start_frame"), ("end_count", "end_frame")):
        found = asof_offset(segs.select("round_id", "seg_id", at), counts, at, limit).select("round_id", "seg_id", F.col("asof_frame").alias("frame_id"))
        own = found.join(counts, ["round_id", "frame_id"], "left").select("round_id", "seg_id", F.coalesce("n", F.lit(-1)).alias(name))
        out = out.join(own, ["round_id", "seg_id"], "left")
    return out.withColumn("rejected", (F.col("start_count") >= 0) & (F.col("end_count") >= 0) & (F.col("end_count") > F.col("start_count")))


def pick_extreme(cands: DataFrame, keys: list[str], zone: Column, value: Column) -> DataFrame:
    """Per group the candidate in the zone of the largest value; ties go to the smaller det_id."""
    best = F.min(F.when(zone, F.struct((-value).alias("v"), "det_id", "cx", "cy"))).alias("b")
    return cands.groupBy(*keys).agg(best, F.count("*").alias("n_candidates")).select(*keys, "n_candidates", F.col("b.det_id").alias("det_id"), F.col("b.cx").alias("cx"), F.col("b.cy").alias("cy"))
