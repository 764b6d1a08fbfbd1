"""Derived input tables, as one SQL text per table that Spark and DuckDB both run.

A name in braces is another derived table or a given one.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from roundhouse.storage import stored

GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

TABLES: dict[str, str] = {
    "segments": """
        SELECT user_id AS round_id, event_id AS seg_id, CAST((event_id * 37) % 600 AS INT) AS start_frame,
               CAST((event_id * 37) % 600 + 9 + (event_id * 13) % 70 AS INT) AS end_frame,
               CASE WHEN event_id % 13 = 0 THEN 'initial hands 1st' WHEN event_id % 13 = 1 THEN 'initial hands 2nd'
                    WHEN event_id % 13 = 2 THEN 'discard' WHEN event_id % 13 = 3 THEN 'clean hand'
                    WHEN event_type = 'click' THEN 'hit' WHEN event_type = 'view' THEN 'call for action'
                    WHEN event_type = 'purchase' THEN 'split' WHEN event_type = 'signup' THEN 'tap' ELSE 'dealer hits' END AS label,
               value / CAST(500 AS DOUBLE) AS score
        FROM {events}""",
    "detections": """
        SELECT l_suppkey AS round_id, CAST(10 * (l_orderkey % 60) AS INT) AS frame_id,
               ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS det_id,
               CAST(520 + 75 * (l_partkey % 12) + l_orderkey % 7 AS DOUBLE) AS cx,
               CAST(660 + (37 * (l_partkey % 12)) % 180 + l_linenumber AS DOUBLE) AS cy,
               CAST(520 + 75 * (l_partkey % 12) + l_orderkey % 7 - 48 AS INT) AS x1, CAST(660 + (37 * (l_partkey % 12)) % 180 + l_linenumber - 60 AS INT) AS y1,
               CAST(520 + 75 * (l_partkey % 12) + l_orderkey % 7 + 48 AS INT) AS x2, CAST(660 + (37 * (l_partkey % 12)) % 180 + l_linenumber + 60 AS INT) AS y2,
               CASE WHEN l_linenumber = 7 THEN 'U' WHEN l_partkey % 12 < 2 THEN '8' WHEN l_partkey % 12 = 2 THEN 'K' WHEN l_partkey % 12 = 3 THEN '10' ELSE CAST(l_partkey % 12 AS STRING) END AS rank,
               CASE WHEN l_partkey % 4 = 0 THEN 'H' WHEN l_partkey % 4 = 1 THEN 'D' WHEN l_partkey % 4 = 2 THEN 'S' ELSE 'C' END AS suit,
               CAST(0.5 AS DOUBLE) + l_quantity / CAST(100 AS DOUBLE) AS conf
        FROM {lineitem}""",
    "dets720": """
        SELECT round_id, frame_id, det_id, cx * CAST(1280 AS DOUBLE) / CAST(1920 AS DOUBLE) AS cx, cy * CAST(1280 AS DOUBLE) / CAST(1920 AS DOUBLE) AS cy,
               CAST(FLOOR(x1 * 2 / CAST(3 AS DOUBLE)) AS INT) AS x1, CAST(FLOOR(y1 * 2 / CAST(3 AS DOUBLE)) AS INT) AS y1,
               CAST(FLOOR(x2 * 2 / CAST(3 AS DOUBLE)) AS INT) AS x2, CAST(FLOOR(y2 * 2 / CAST(3 AS DOUBLE)) AS INT) AS y2, rank, suit, conf
        FROM {detections}""",
    "parting": """
        SELECT round_id, frame_id, det_id, cx + CASE WHEN CAST(FLOOR((cx * 1.5 - 519.5) / 75) AS INT) % 2 = 1 THEN 0.6 * (frame_id % 50) ELSE 0 END AS cx, cy, x1, y1, x2, y2, rank, suit, conf
        FROM (SELECT round_id, CAST(FLOOR(frame_id / 5) AS INT) AS frame_id, det_id, cx, cy, x1, y1, x2, y2, rank, suit, conf FROM {dets720}) d""",
    "hands": """
        SELECT CAST(10 * FLOOR(o_orderkey / 12000) + o_orderkey % 10 AS BIGINT) AS round_id, CAST(FLOOR(o_orderkey / 20) AS INT) % 600 AS frame_id, CAST(FLOOR(o_orderkey / 10) AS INT) % 2 AS hand,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN CAST(0 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) + ((o_orderkey * 17) % 1000) / CAST(2500 AS DOUBLE) END AS x8,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN CAST(0 AS DOUBLE)
                    ELSE CAST(0.64 AS DOUBLE) + CAST(0.004 AS DOUBLE) * ABS(CAST(FLOOR(o_orderkey / 20) AS INT) % 20 - 10) END AS y8
        FROM {orders}""",
    "keypoints21": """
        SELECT round_id, frame_id, hand, kp, CASE WHEN x8 = 0 THEN x8 ELSE x8 + CAST(0.001 AS DOUBLE) * (kp - 8) END AS x,
               CASE WHEN x8 = 0 THEN y8 ELSE y8 + CAST(0.0005 AS DOUBLE) * (kp - 8) END AS y
        FROM {hands} CROSS JOIN (SELECT 0 AS kp UNION ALL SELECT 8 UNION ALL SELECT 12 UNION ALL SELECT 16 UNION ALL SELECT 20) AS k""",
    "chunks": """
        SELECT DISTINCT video_id, chunk_start
        FROM (SELECT video_id, chunk_start, o_orderpriority, MIN(CASE WHEN chunk_start = 0 THEN o_orderpriority END) OVER (PARTITION BY video_id) AS first
              FROM (SELECT CAST(10 * FLOOR(o_orderkey / 400) + o_orderkey % 10 AS BIGINT) AS video_id, CAST(300 * (CAST(FLOOR(o_orderkey / 10) AS INT) % 40) AS INT) AS chunk_start, o_orderpriority FROM {orders}) o) p
        WHERE o_orderpriority <> '5-LOW' AND (first IS NULL OR first <> '1-URGENT')""",
    "rounds": """
        SELECT c_custkey AS round_id, CAST(FLOOR(c_custkey / 4) AS BIGINT) AS video_id, CAST(1 + (c_custkey * 131) % 9000 AS INT) AS start_1idx,
               CAST(401 + (c_custkey * 131) % 9000 + (c_custkey * 29) % 2500 AS INT) AS end_1idx
        FROM {customer}""",
    "features": """
        SELECT CAST(FLOOR(vec_id / 50) AS INT) AS video_id, CAST(vec_id % 50 AS INT) AS frame_idx, label AS label_id, embedding FROM {embeddings}""",
    "feature_segments": """
        SELECT f.video_id, CAST(f.frame_idx AS INT) AS start_frame, CAST(f.frame_idx + 9 AS INT) AS end_frame, f.label_id FROM {features} f WHERE f.frame_idx % 10 = 0""",
    "boxes": """
        SELECT round_id, det_id AS box_id, frame_id AS anchor_frame, CAST(1 + det_id % 3 AS INT) AS n_keyframes, x1, y1, x2, y2
        FROM {detections} WHERE conf > 0.8""",
    "tasks": """
        SELECT conv_id AS task_id, turn AS ann_seq, (conv_id + turn) % 5 = 0 AS was_cancelled, CAST(LENGTH(text) % 4 AS INT) AS n_results,
               CASE WHEN turn % 3 = 0 THEN NULL ELSE CONCAT('2025-10-0', CAST(1 + (conv_id * 7 + turn * 3) % 9 AS STRING)) END AS updated_at,
               CASE WHEN turn % 6 = 3 THEN NULL ELSE CONCAT('2025-10-0', CAST(1 + (conv_id * 3 + turn * 5) % 9 AS STRING)) END AS created_at
        FROM {conversations}""",
    "keypoints": """
        SELECT l_orderkey % 500 AS task_id, CAST(l_partkey % 4 AS INT) AS class_id, CONCAT('C', CAST(1 + (l_linenumber + l_suppkey) % 9 AS STRING)) AS kp_label,
               ROW_NUMBER() OVER (PARTITION BY l_orderkey % 500 ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_suppkey) AS seq,
               2 * l_quantity AS x_pct, 100 * ((l_partkey * 13) % 97) / CAST(97 AS DOUBLE) AS y_pct
        FROM {lineitem}""",
    "asset_names": """
        SELECT o_orderkey AS asset_id, CASE WHEN o_orderkey % 11 = 0 THEN CONCAT('bad-name-', CAST(o_orderkey AS STRING), '.json')
               ELSE CONCAT('2025-10-', LPAD(CAST(1 + o_orderkey % 28 AS STRING), 2, '0'), '_06-05-15_', LPAD(CAST(FLOOR(o_orderkey / 28) % 1000000 AS BIGINT_TEXT), 6, '0'), '_',
                           LPAD(CAST((o_orderkey * 300) % 1000000 AS STRING), 6, '0'), '_card.json') END AS file_name
        FROM {orders}""",
    "frame_images": """
        SELECT det_id AS image_id, CASE WHEN det_id % 13 = 0 THEN CONCAT('r', CAST(round_id AS STRING), '-frame', CAST(frame_id AS STRING), '.png')
               ELSE CONCAT('r_f', CAST(round_id AS STRING), '_f', CAST(frame_id AS STRING), '.png') END AS file_name, round_id
        FROM {detections}""",
    "frame_text": """
        SELECT doc_id % 50 AS round_id, CAST(FLOOR(doc_id / 50) AS INT) AS frame_id, CASE WHEN doc_id % 9 = 0 THEN 'GAME PAUS3D DUE TO INACTWVITY' ELSE text END AS text
        FROM {documents}""",
    "seat_obbs": """
        SELECT r.round_id, s.seat_id, s.x0 AS c0x, s.y0 AS c0y, s.x0 + s.w AS c1x, s.y0 + s.t AS c1y, s.x0 + s.w - s.t AS c2x, s.y0 + s.t + s.h AS c2y, s.x0 - s.t AS c3x, s.y0 + s.h AS c3y
        FROM (SELECT DISTINCT round_id FROM {detections}) r CROSS JOIN (
            SELECT CAST(k AS INT) AS seat_id, CAST(330 + 80 * k AS DOUBLE) AS x0, CAST(430 + (k * 23) % 60 AS DOUBLE) AS y0,
                   CAST(90 AS DOUBLE) AS w, CAST(100 AS DOUBLE) AS h, CAST((k % 3) * 10 AS DOUBLE) AS t
            FROM (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL SELECT 6 UNION ALL SELECT 7) q) s""",
    "tracks": """
        SELECT round_id, CAST(FLOOR((cx - 347) / 50) AS INT) AS track_id, frame_id, det_id, cx, cy, rank, suit, conf FROM {dets720}""",
}


def _needs(sql: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", sql)


def duckdb_text(sql: str) -> str:
    """A query over derived tables, with the tables it needs as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES and name not in order:
            for other in _needs(TABLES[name]):
                visit(other)
            order.append(name)

    for name in _needs(sql):
        visit(name)
    body = sql.strip()
    texts = [body, *[TABLES[x] for x in order]]
    often = {x for x in order if sum(t.count(f"{{{x}}}") for t in texts) > 1}  # computed once, also where both sides of a join read them
    ctes = [f"fx_{name} AS {'MATERIALIZED ' if name in often else ''}({TABLES[name]})" for name in order]
    if (start := next((x for x in ("WITH RECURSIVE ", "WITH ") if body.startswith(x)), None)) and ctes:
        body = start + ", ".join([*ctes, body[len(start) :]])
    elif ctes:
        body = "WITH " + ", ".join(ctes) + " " + body
    body = re.sub(r"\{(\w+)\}", lambda m: f"fx_{m[1]}" if m[1] in TABLES else m[1], body)
    return body.replace("CAST(FLOOR(o_orderkey / 28) % 1000000 AS BIGINT_TEXT)", "CAST(CAST(FLOOR(o_orderkey / 28) % 1000000 AS BIGINT) AS VARCHAR)").replace("AS STRING)", "AS VARCHAR)")


def spark_text(name: str) -> str:
    """A table's text for Spark. Detections are numbered before anything is derived, and by round_id itself: so only given columns are shuffled, and Spark knows
    afterwards that a round lies in one task. Names, types and rows are those of the text."""
    text = TABLES[name]
    if name == "detections":
        number = re.search(r"ROW_NUMBER\(\) OVER \([^)]*\)", text)[0]
        inner = f"(SELECT *, {number.replace('PARTITION BY l_suppkey', 'PARTITION BY round_id')} AS det_id FROM (SELECT *, l_suppkey AS round_id FROM {{lineitem}}) l) n"
        text = text.replace(f"{number} AS det_id", "det_id").replace("l_suppkey AS round_id", "round_id").replace("FROM {lineitem}", f"FROM {inner}")
    return text


#: Detections of a task that puts them in order several times, some 400 bytes each, while FREE_TASKS suffice for it; and the most that it may get. Up to FREE_TASKS, Spark writes a
#: shuffled row as it comes; for more, a reading task first holds and orders its rows, which spill once where files are read in large parts.
TASK_ROWS, FREE_TASKS, MOST_TASK_ROWS = 300_000, 200, 1_200_000


def tasks_for(rows: int) -> int:
    """Tasks that so many detections are dealt into."""
    return max(min(-(-rows // TASK_ROWS), FREE_TASKS), -(-rows // MOST_TASK_ROWS))


_WRITTEN: dict[tuple[str, str], dict[str, DataFrame]] = {}


def prepare(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("detections",)) -> None:
    """Writes derived tables once, so that the queries of this session read them as tables: what takes the place of input isn't timed with a query."""
    t = Inputs(spark, sf_dir)
    _WRITTEN[spark.sparkContext.applicationId, sf_dir] = {x: stored(getattr(t, x), f"derived-{x}") for x in names}


class Inputs:
    """Given and derived tables of one folder: t.segments, t.lineitem and so on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._seen = spark, sf_dir, dict(_WRITTEN.get((spark.sparkContext.applicationId, sf_dir), {}))

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._seen:
            if name in GIVEN:
                self._seen[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._seen[name] = self.sql(spark_text(name))
        return self._seen[name]

    @property
    def dealt(self) -> Inputs:
        """The same tables, with detections dealt by round into tasks by their count before they are numbered: for queries that put all of them in order again where they lie.

        Left to itself, Spark fills a task by packed size or by a set number of tasks, and the rows take many times that when they are put in order.
        """
        out = Inputs(self.spark, self.sf_dir)
        if "detections" not in out._seen and (tasks := tasks_for(self.lineitem.count())) > self.spark.sparkContext.defaultParallelism:
            out._seen["lineitem"] = self.lineitem.repartition(tasks, "l_suppkey")
        return out

    def sql(self, text: str) -> DataFrame:
        text = text.replace("CAST(FLOOR(o_orderkey / 28) % 1000000 AS BIGINT_TEXT)", "CAST(CAST(FLOOR(o_orderkey / 28) % 1000000 AS BIGINT) AS STRING)")
        return self.spark.sql(text, **{x: getattr(self, x) for x in _needs(text)})
