"""The item tracker over a stream: state per round, one update per batch of its frames.

The state holds the live tracks (last place, last frame, observations) and the last processed frame. Frames not
after that one are late: they are dropped and counted. A track that hasn't been seen for `recency` frames is
closed and, if it was seen often and long enough, emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last_frame long, next_id int, late long, ids array<int>, xs array<double>, ys array<double>, first array<long>, last array<long>, n array<int>"
OUT = "round_id long, track_key int, first_frame long, last_frame long, n_obs int, late_rows long"


class Tracks:
    def __init__(self, state: tuple | None):
        self.frame, self.next_id, self.late, *columns = state or (-1, 0, 0, [], [], [], [], [], [])
        self.live = [list(x) for x in zip(*columns, strict=True)]

    def state(self) -> tuple:
        columns = [list(x) for x in zip(*self.live, strict=True)] if self.live else [[] for _ in range(6)]
        return (self.frame, self.next_id, self.late, *columns)

    def add_frame(self, frame: int, dets: list[tuple[float, float]], reach: float, recency: int) -> list[list]:
        """Detections in order of falling confidence; returns the tracks that this frame closes."""
        closed = [t for t in self.live if frame - t[4] > recency]
        self.live = [t for t in self.live if frame - t[4] <= recency]
        claimed: set[int] = set()
        for x, y in dets:
            best, far = None, math.inf
            for t in self.live:
                if t[0] not in claimed and (d := math.hypot(x - t[1], y - t[2])) < far:
                    best, far = t, d
            if best is not None and far <= reach:
                claimed.add(best[0])
                best[1], best[2], best[4], best[5] = x, y, frame, best[5] + 1
            else:
                self.live.append([self.next_id, x, y, frame, frame, 1])
                self.next_id += 1
        self.frame = frame
        return closed


def known(x) -> bool:
    """Neither None nor NaN, as which pandas gives a null."""
    return x is not None and x == x


def detections(frames: list[pd.DataFrame]) -> list[tuple]:
    """(frame_id, det_id, conf, cx, cy) of the rows with a det_id, in any order. Plain rows: a round's share of a batch is small, and pandas takes longer for a call than for its rows."""
    columns = ("frame_id", "det_id", "conf", "cx", "cy")
    return [row for pdf in frames for row in zip(*(pdf[c].tolist() for c in columns), strict=True) if known(row[1])]


def in_order(rows: list[tuple]) -> list[tuple]:
    """Rows of detections() that have a frame, by frame, falling confidence (null: last) and det_id."""
    return sorted((r for r in rows if known(r[0])), key=lambda r: (r[0], (0, -r[2]) if known(r[2]) else (1, 0), r[1]))


def track_stream(dets: DataFrame, reach: float = 35.0, recency: int = 75, least_obs: int = 30, least_span: int = 50) -> DataFrame:
    """Closed tracks of a stream of detections (round_id, frame_id, det_id, cx, cy, conf).

    A row without det_id says that its round has ended: the live tracks are closed too and the state is dropped. late_rows is the number of the round's late rows when a track
    closed; a round without such a track says nothing of them (timed_tracker gives each late row, and closes silent rounds by itself).
    """

    def good(t: list) -> bool:
        return t[5] >= least_obs and t[4] - t[3] >= least_span

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tracks = Tracks(state.get if state.exists else None)
        closed: list[list] = []
        batches = list(frames)
        ended, rows = any(pdf["det_id"].isna().any() for pdf in batches), detections(batches)
        fresh = [r for r in in_order(rows) if r[0] > tracks.frame]
        tracks.late += len(rows) - len(fresh)
        for frame, own in groupby(fresh, key=lambda r: r[0]):
            closed += tracks.add_frame(int(frame), [r[3:] for r in own], reach, recency)
        if ended:
            closed += tracks.live
            if state.exists:
                state.remove()
        else:
            state.update(tracks.state())
        out = [(key[0], t[0], t[3], t[4], t[5], tracks.late) for t in closed if good(t)]
        yield pd.DataFrame(out, columns=[x.split()[0] for x in OUT.split(", ")])

    return dets.groupBy("round_id").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
