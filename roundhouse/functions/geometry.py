"""Plane geometry on columns: everything stays an expression that Catalyst compiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seat centres in pixels of a 1920 x 1080 image, dealer first.
SEATS_PX = ((972, 723), (1389, 777), (1257, 829), (1125, 861), (963, 892), (796, 879), (688, 837), (562, 778))
IMAGE = (1920.0, 1080.0)
ANGULAR_WEIGHT = 0.3
MAX_SEAT_DISTANCE = 200 / 1920


def r4(x: Column) -> Column:
    """Four decimals by floor(x * 10000 + 0.5), the same in every engine with IEEE doubles."""
    return F.floor(x * 10000 + 0.5) / 10000.0


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def to_percent(x1: Column, y1: Column, x2: Column, y2: Column, w: float, h: float) -> dict[str, Column]:
    """A pixel box as left, top, width and height in percent of the image."""
    return {"x_pct": x1 / w * 100, "y_pct": y1 / h * 100, "w_pct": (x2 - x1) / w * 100, "h_pct": (y2 - y1) / h * 100}


def overlap_area(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Pixels that two boxes (x1, y1, x2, y2) share."""
    wide = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    high = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    return wide * high


def union_box(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[2], b[2]), F.greatest(a[3], b[3])]


def interval_iou(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Intersection over union of two ranges; 0 where the union is empty."""
    shared = F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))
    union = (e1 - s1) + (e2 - s2) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def grid_key(x: Column, size: int = 10) -> Column:
    """The nearest multiple of size, halves to even."""
    return (F.bround(x / size) * size).cast("int")


def seat_distance(cx: Column, cy: Column, seat: int) -> Column:
    """Distance of a 1080p point to a seat: Euclidean for the dealer, else blended with the angle around the dealer."""
    points = [(x / IMAGE[0], y / IMAGE[1]) for x, y in SEATS_PX]
    (dx, dy), (sx, sy) = points[0], points[seat]
    px, py = cx / IMAGE[0], cy / IMAGE[1]
    straight = distance(px, py, F.lit(sx), F.lit(sy))
    if seat == 0:
        return straight
    turn = F.abs(F.atan2(py - dy, px - dx) - math.atan2(sy - dy, sx - dx))
    turn = F.least(turn, 2 * math.pi - turn)
    return (1 - ANGULAR_WEIGHT) * straight + ANGULAR_WEIGHT * turn * math.hypot(sx - dx, sy - dy)


def nearest_seat(cx: Column, cy: Column) -> Column:
    """The nearest seat within reach, else null; equal distances go to the smaller seat."""
    best = F.least(*[F.struct(seat_distance(cx, cy, k).alias("d"), F.lit(k).alias("seat")) for k in range(len(SEATS_PX))])
    return F.when(best["d"] <= MAX_SEAT_DISTANCE, best["seat"])


Corners = Sequence[tuple[Column, Column]]


def corners(prefix: str = "") -> list[tuple[Column, Column]]:
    """The columns c0x, c0y to c3x, c3y of an oriented box."""
    return [(F.col(f"{prefix}c{k}x"), F.col(f"{prefix}c{k}y")) for k in range(4)]


def point_in_obb(px: Column, py: Column, box: Corners) -> Column:
    """Whether both projections on the edges at corner 0 stay within the edges."""
    (ox, oy), (ax, ay), _, (bx, by) = box
    ux, uy, vx, vy = ax - ox, ay - oy, bx - ox, by - oy
    along, across = (px - ox) * ux + (py - oy) * uy, (px - ox) * vx + (py - oy) * vy
    return (along >= 0) & (along <= ux * ux + uy * uy) & (across >= 0) & (across <= vx * vx + vy * vy)


def segment_distance(px: Column, py: Column, a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    ex, ey = b[0] - a[0], b[1] - a[1]
    length = ex * ex + ey * ey
    t = F.when(length == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((px - a[0]) * ex + (py - a[1]) * ey, length))))
    return distance(px, py, a[0] + t * ex, a[1] + t * ey)


def obb_distance(px: Column, py: Column, box: Corners) -> Column:
    """0 inside, else the distance to the nearest edge."""
    edges = [segment_distance(px, py, box[k], box[(k + 1) % 4]) for k in range(4)]
    return F.when(point_in_obb(px, py, box), F.lit(0.0)).otherwise(F.least(*edges))


def project_obb(px: Column, py: Column, box: Corners, axis: str) -> Column:
    """Length from corner 0 along the 'long' or 'short' edge; 0 for an edge without length."""
    (ox, oy), (ax, ay), _, (bx, by) = box
    first, second = distance(ax, ay, ox, oy), distance(bx, by, ox, oy)
    use_first = (first >= second) if axis == "long" else ~(first >= second)
    ex, ey = F.when(use_first, ax - ox).otherwise(bx - ox), F.when(use_first, ay - oy).otherwise(by - oy)
    length = F.when(use_first, first).otherwise(second)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide((px - ox) * ex + (py - oy) * ey, length))


def upright_frame(px: Column, py: Column, box: Corners) -> tuple[Column, Column]:
    """Place in the frame whose y edge is the more vertical one; null if an edge is shorter than a pixel."""
    (ox, oy), (ax, ay), _, (bx, by) = box
    first, second = distance(ax, ay, ox, oy), distance(bx, by, ox, oy)
    up_is_first = F.abs(ay - oy) >= F.abs(by - oy)
    on_first = F.try_divide((px - ox) * (ax - ox) + (py - oy) * (ay - oy), first)
    on_second = F.try_divide((px - ox) * (bx - ox) + (py - oy) * (by - oy), second)
    good = (first >= 1) & (second >= 1)
    return F.when(good, F.when(up_is_first, on_second).otherwise(on_first)), F.when(good, F.when(up_is_first, on_first).otherwise(on_second))


def rotated_corners(x: Column, y: Column, w: Column, h: Column, degrees: Column) -> list[tuple[Column, Column]]:
    """Corners of a box turned about its top left corner, clockwise from there."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    zero = F.lit(0.0)
    return [(x + dx * c - dy * s, y + dx * s + dy * c) for dx, dy in ((zero, zero), (w, zero), (w, h), (zero, h))]


def norm_rank(rank: Column) -> Column:
    """Ten-valued ranks as one class; null for unknown ones."""
    return F.when(rank.isin("10", "J", "Q", "K"), F.lit("T")).when(rank.isin("", "U", "?"), None).otherwise(rank)
