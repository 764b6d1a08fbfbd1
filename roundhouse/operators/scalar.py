"""Projections, filters and predicates over detections, hands and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g

SCALE = 1280 / 1920
DEALER_BOX = (535, 411, 800, 489)
# Texts on the screen that mark a paused or inactive game.
PAUSE_PATTERNS = (r"\bpaus\w*d\b", r"\binact\w{2,6}ity\b")


def scale_dets(df: DataFrame) -> DataFrame:
    """1080p to 720p: centres as doubles, box corners truncated."""
    boxes = {n: F.floor(F.col(n) * 2 / 3.0).cast("int") for n in ("x1", "y1", "x2", "y2")}
    return df.withColumns({"cx": F.col("cx") * 1280.0 / 1920.0, "cy": F.col("cy") * 1280.0 / 1920.0, **boxes})


def stage_duration(df: DataFrame, labels: list[str], least: int) -> DataFrame:
    """Rows of the labels with passed and, where the duration is short, stage and reason."""
    rows = df.where(F.col("label").isin(labels)).withColumn("duration", F.col("end_frame") - F.col("start_frame") + 1)
    short = F.col("duration") < least
    return rows.withColumns({"passed": ~short, "stage": F.when(short, "stage1_duration"), "reason": F.when(short, F.concat(F.lit("duration="), F.col("duration"), F.lit(f" < {least}")))})


def in_zone(rule: str, cx: str = "cx", cy: str = "cy") -> Column:
    """hit and split: y >= 450; call: y > 450; tap: y >= 480; dealer: inside DEALER_BOX, borders too."""
    x1, y1, x2, y2 = DEALER_BOX
    x, y = F.col(cx), F.col(cy)
    return {"hit": y >= 450, "split": y >= 450, "call": y > 450, "tap": y >= 480, "dealer": x.between(x1, x2) & y.between(y1, y2)}[rule]


def normalize_label(label: Column, keep: list[str]) -> Column:
    return F.when(label.isin(keep), label).otherwise(F.lit("background"))


def parse_slot(label: Column, slots: int = 7) -> Column:
    """C1 to C<slots> as 0 to slots - 1, anything else -1."""
    n = F.regexp_extract(label, r"^C(\d+)$", 1).try_cast("int")
    return F.when(n.between(1, slots), n - 1).otherwise(F.lit(-1))


def hand_position(kps: DataFrame, keys: list[str]) -> DataFrame:
    """Per hand the fingertip (8), else the wrist (0), in 720p pixels; null if the hand's mean is under 0.1 or neither is visible."""
    at = lambda kp, axis: F.max(F.when(F.col("kp") == kp, F.col(axis)))
    hand = kps.groupBy(*keys).agg(F.avg((F.col("x") + F.col("y")) / 2).alias("mean"), *[at(kp, a).alias(f"{a}{kp}") for kp in (8, 0) for a in "xy"])
    seen = [(F.col(f"x{k}") > 0.01) & (F.col(f"y{k}") > 0.01) for k in (8, 0)]
    pick = lambda axis, size: F.when(F.col("mean") >= 0.1, F.when(seen[0], F.col(f"{axis}8") * size).when(seen[1], F.col(f"{axis}0") * size))
    return hand.select(*keys, pick("x", 1280.0).alias("hx"), pick("y", 720.0).alias("hy"))


def l2_normalize(v: Column) -> Column:
    """v over its length; a vector of zeros stays so."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: x.cast("double") / F.when(norm == 0, F.lit(1e-8)).otherwise(norm))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def boxes_of(df: DataFrame, a: str = "", b: str = "b_") -> tuple[list[Column], list[Column]]:
    names = ("x1", "y1", "x2", "y2")
    return [F.col(a + n) for n in names], [F.col(b + n) for n in names]


def obb_points(points: DataFrame, obbs: DataFrame) -> DataFrame:
    """Every point with every oriented box of its round: the boxes of a round are few."""
    return points.join(obbs, "round_id")


def with_obb_distance(rows: DataFrame, name: str = "distance") -> DataFrame:
    """rows (cx, cy, c0x to c3y) with their distance as obb_distance gives it: by columns of steps, each a short compiled method. As one expression it is too long for the JVM to compile."""
    col = lambda n, k: F.col(f"__{n}{k}")
    each = lambda n, f: {f"__{n}{k}": f(k) for k in range(4)}
    side = lambda a: lambda k: F.col(f"c{(k + 1) % 4}{a}") - F.col(f"c{k}{a}")
    off = lambda a: lambda k: F.col(f"c{a}") - (F.col(f"c{k}{a}") + col("t", k) * col(f"e{a}", k))
    along = lambda k: (F.col("cx") - F.col(f"c{k}x")) * col("ex", k) + (F.col("cy") - F.col(f"c{k}y")) * col("ey", k)
    out = rows.withColumns(each("ex", side("x")) | each("ey", side("y")))
    out = out.withColumns(each("l", lambda k: col("ex", k) * col("ex", k) + col("ey", k) * col("ey", k)) | each("a", along))
    out = out.withColumns(each("t", lambda k: F.when(col("l", k) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(col("a", k), col("l", k)))))))
    out = out.withColumns(each("ox", off("x")) | each("oy", off("y")))
    out = out.withColumns(each("d", lambda k: F.sqrt(col("ox", k) * col("ox", k) + col("oy", k) * col("oy", k))) | {"__v": (F.col("cx") - F.col("c0x")) * -F.col("__ex3") + (F.col("cy") - F.col("c0y")) * -F.col("__ey3")})
    inside = (col("a", 0) >= 0) & (col("a", 0) <= col("l", 0)) & (F.col("__v") >= 0) & (F.col("__v") <= col("l", 3))
    return out.select(*rows.columns, F.when(inside, F.lit(0.0)).otherwise(F.least(*[col("d", k) for k in range(4)])).alias(name))


def with_rotated(df: DataFrame) -> DataFrame:
    """Columns c0x to c3y, rounded to three decimals, from x, y, w, h and degrees."""
    out = g.rotated_corners(*[F.col(x) for x in ("x", "y", "w", "h", "degrees")])
    return df.withColumns({f"c{k}{axis}": F.floor(v * 1000 + 0.5) / 1000.0 for k, p in enumerate(out) for axis, v in zip("xy", p, strict=True)})
