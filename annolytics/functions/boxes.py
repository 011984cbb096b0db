"""Boxes as columns: x, y, w, h (left, top, width, height) unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession, functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", names: tuple[str, str, str, str] = ("x", "y", "w", "h")) -> Box:
    return tuple(F.col(prefix + n) for n in names)


def known() -> Column:
    """Whether none of x, y, w, h is null; written without a lambda, which would be interpreted row by row."""
    x, y, w, h = (c.isNotNull() for c in box())
    return x & y & w & h


def to_corners(b: Box) -> Box:
    """x, y, w, h -> left, top, right, bottom."""
    x, y, w, h = b
    return x, y, x + w, y + h


def to_centre(b: Box) -> Box:
    """x, y, w, h -> centre and w, h."""
    x, y, w, h = b
    return x + w / 2, y + h / 2, w, h


def corners_to_box(c: Box) -> Box:
    return c[0], c[1], c[2] - c[0], c[3] - c[1]


def corners_to_centre(c: Box) -> Box:
    return to_centre(corners_to_box(c))


def centre_to_box(c: Box) -> Box:
    cx, cy, w, h = c
    return cx - w / 2, cy - h / 2, w, h


def centre_to_corners(c: Box) -> Box:
    return to_corners(centre_to_box(c))


def area(b: Box) -> Column:
    return b[2] * b[3]


def centre(b: Box) -> tuple[Column, Column]:
    return b[0] + b[2] / 2, b[1] + b[3] / 2


def scale(b: Box, sx: Column | float, sy: Column | float) -> Box:
    return b[0] * sx, b[1] * sy, b[2] * sx, b[3] * sy


def _clamp(v: Column, most: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)), most)


def clip(c: Box, height: Column, width: Column) -> Box:
    """Corners within 0 to width and 0 to height."""
    return _clamp(c[0], width), _clamp(c[1], height), _clamp(c[2], width), _clamp(c[3], height)


def normalize(b: Box, width: Column, height: Column) -> Box:
    """x, y, w, h over the image's size, within 0 to 1."""
    one = F.lit(1.0)
    return tuple(_clamp(v / side, one) for v, side in zip(b, (width, height, width, height), strict=True))


def scale_to_image(b: Box, width: Column, height: Column) -> Box:
    """Relative x, y, w, h in pixels, as corners within the image."""
    return clip(to_corners(scale(b, width, height)), height, width)


def intersection(a: Box, b: Box) -> Column:
    ax, ay, ar, ab = to_corners(a)
    bx, by, br, bb = to_corners(b)
    return F.greatest(F.least(ar, br) - F.greatest(ax, bx), F.lit(0.0)) * F.greatest(F.least(ab, bb) - F.greatest(ay, by), F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where both boxes are empty."""
    both = intersection(a, b)
    union = a[2] * a[3] + b[2] * b[3] - both
    return F.when(union > 0, both / union).otherwise(0.0)


def union(a: Box, b: Box) -> Column:
    return area(a) + area(b) - intersection(a, b)


def giou(a: Box, b: Box) -> Column:
    """IoU less the share of the hull that neither box covers; 0 parts where union or hull
    is empty."""
    ax, ay, ar, ab = to_corners(a)
    bx, by, br, bb = to_corners(b)
    hull = (F.greatest(ar, br) - F.least(ax, bx)) * (F.greatest(ab, bb) - F.least(ay, by))
    return iou(a, b) - F.when(hull > 0, (hull - union(a, b)) / hull).otherwise(0.0)


def ioa(a: Box, b: Box, of_second: bool = False) -> Column:
    """Common area over that of the first box, or of the second; 0 where it is empty."""
    own = area(b if of_second else a)
    return F.when(own > 0, intersection(a, b) / own).otherwise(0.0)


def euclidean_similarity(a: tuple[Column, Column], b: tuple[Column, Column], zero_at: float = 2.0) -> Column:
    distance = F.sqrt((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]))
    return F.greatest(F.lit(0.0), 1 - distance / zero_at)


def point_box_distance(x: Column, y: Column, c: Box) -> Box:
    """Distance of a point from the left, top, right and bottom of corners c."""
    return x - c[0], y - c[1], c[2] - x, c[3] - y


def normalize_angle(angle: Column) -> Column:
    """Degrees within [-180, 180)."""
    return F.pmod(angle + 180, F.lit(360.0)) - 180


def rotated_to_corners(b: Sequence[Column]) -> Box:
    """Centre, w, h and angle in degrees -> corners of the upright box around it."""
    cx, cy, w, h, angle = b
    c, s = F.abs(F.cos(F.radians(angle))), F.abs(F.sin(F.radians(angle)))
    wide, high = c * w + s * h, c * h + s * w
    return cx - wide / 2, cy - high / 2, cx + wide / 2, cy + high / 2


def to_rotated(b: Box) -> tuple[Column, ...]:
    """x, y, w, h -> centre, w, h and an angle of 0."""
    return (*to_centre(b), F.lit(0.0))


def rotated_clip(b: Sequence[Column], height: Column, width: Column, most_angle: float = 1.0) -> tuple[Column, ...]:
    """A rotated box cut to the image if its angle is within most_angle, else as it is; the
    clipped one is never wider or higher than before."""
    angle = normalize_angle(b[4])
    cut = corners_to_centre(clip(centre_to_corners(tuple(b[:4])), height, width))
    cut = cut[0], cut[1], F.least(b[2], cut[2]), F.least(b[3], cut[3])
    near = F.abs(angle) <= most_angle
    return (*(F.when(near, v).otherwise(u) for u, v in zip(b[:4], cut, strict=True)), angle)


def inside_rotated(b: Sequence[Column], width: Column, height: Column, tolerance: float = 0.0) -> Column:
    """Whether the corners, to 9 decimals, are inside: the angle's rounding decides no tie."""
    x0, y0, x1, y1 = (F.round(c, 9) for c in rotated_to_corners(b))
    return (x0 >= -tolerance) & (y0 >= -tolerance) & (x1 < width + tolerance) & (y1 < height + tolerance)


def polygon_area(xs: Column, ys: Column) -> Column:
    """Area of the polygon of arrays of coordinates; below three corners 0."""
    def cross(a: Column, b: Column) -> Column:
        turned = F.concat(F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))), F.slice(b, 1, 1))
        return F.aggregate(F.zip_with(a, turned, lambda u, v: u * v), F.lit(0.0), lambda t, v: t + v)

    return F.when(F.size(xs) > 2, F.abs(cross(xs, ys) - cross(ys, xs)) / 2).otherwise(0.0)


def crop(c: Box, left: Column, top: Column, wide: Column, high: Column) -> Box:
    """Corners in a region cut out of the image."""
    return clip((c[0] - left, c[1] - top, c[2] - left, c[3] - top), high, wide)


def flip(c: Box, width: Column) -> Box:
    """Corners in the image turned left to right."""
    return width - c[2], c[1], width - c[0], c[3]


def pad(c: Box, left: Column, top: Column) -> Box:
    return c[0] + left, c[1] + top, c[2] + left, c[3] + top


def resize_target(width: Column, height: Column, size: int, most: int | None = None) -> tuple[Column, Column]:
    """Width and height of an image whose shorter side becomes `size`, or less where the
    longer one would pass `most`; sides are cut to whole pixels."""
    short, long = F.least(width, height), F.greatest(width, height)
    goal = F.lit(size)
    if most is not None:
        goal = F.when(long / short * size > most, F.round(most * short / long).cast("int")).otherwise(goal)
    kept = short == goal
    other = F.floor(goal * long / short)
    return (F.when(kept, width).when(width < height, goal).otherwise(other), F.when(kept, height).when(width < height, other).otherwise(goal))


def rescale(c: Box, factor: float, width: Column, height: Column) -> Box:
    """Corners scaled about their centre, within the image."""
    cx, cy, w, h = corners_to_centre(c)
    return clip(centre_to_corners((cx, cy, w * factor, h * factor)), height, width)


def keypoint_cell(x: Column, y: Column, roi: Box, n: int) -> tuple[Column, Column]:
    """Cell of a point in the n x n grid of a region (corners), row by row, and whether the
    point is in the region; a point on the right or lower edge is in the last cell."""
    def place(v: Column, low: Column, high: Column) -> Column:
        return F.when(v == high, n - 1).otherwise(F.floor((v - low) * n / F.greatest(high - low, F.lit(1e-9))))

    i, j = place(x, roi[0], roi[2]), place(y, roi[1], roi[3])
    valid = (i >= 0) & (j >= 0) & (i < n) & (j < n)
    return F.when(valid, j * n + i).otherwise(0).cast("long"), valid


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def detection_score(logit: Column, presence: Column | None = None) -> Column:
    return sigmoid(logit) if presence is None else sigmoid(logit) * sigmoid(presence)


def decode_box(b: Box, width: Column, height: Column) -> Box:
    """Relative centre, w, h -> corners in pixels."""
    return tuple(v * side for v, side in zip(centre_to_corners(b), (width, height, width, height), strict=True))


def away_from_border(b: Box, width: Column, height: Column, margin: float = 0.025) -> Column:
    """Whether the centre is strictly inside the margin on both axes."""
    cx, cy, _, _ = to_centre(b)
    u, v = cx / width, cy / height
    return (u > margin) & (u < 1 - margin) & (v > margin) & (v < 1 - margin)


#: Bodies of the SQL functions: name, arguments, body. Boxes are x, y, w, h.
SQL_FUNCTIONS = {
    "box_area": ("w DOUBLE, h DOUBLE", "w * h"),
    "box_inter": ("ax DOUBLE, ay DOUBLE, aw DOUBLE, ah DOUBLE, bx DOUBLE, by DOUBLE, bw DOUBLE, bh DOUBLE", "greatest(least(ax + aw, bx + bw) - greatest(ax, bx), 0D) * greatest(least(ay + ah, by + bh) - greatest(ay, by), 0D)"),
    "box_union": ("ax DOUBLE, ay DOUBLE, aw DOUBLE, ah DOUBLE, bx DOUBLE, by DOUBLE, bw DOUBLE, bh DOUBLE", "aw * ah + bw * bh - box_inter(ax, ay, aw, ah, bx, by, bw, bh)"),
    "box_iou": ("ax DOUBLE, ay DOUBLE, aw DOUBLE, ah DOUBLE, bx DOUBLE, by DOUBLE, bw DOUBLE, bh DOUBLE", "coalesce(box_inter(ax, ay, aw, ah, bx, by, bw, bh) / nullif(box_union(ax, ay, aw, ah, bx, by, bw, bh), 0D), 0D)"),
    "box_ioa": ("ax DOUBLE, ay DOUBLE, aw DOUBLE, ah DOUBLE, bx DOUBLE, by DOUBLE, bw DOUBLE, bh DOUBLE", "coalesce(box_inter(ax, ay, aw, ah, bx, by, bw, bh) / nullif(aw * ah, 0D), 0D)"),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the box functions callable from SQL; Catalyst puts their bodies in place."""
    for name, (arguments, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS DOUBLE RETURN {body}")
