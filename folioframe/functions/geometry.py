"""Printing geometry: signatures, slots, creep, crops and boxes as column expressions.

A signature is a pile of folded leaves; each leaf carries four pages, two on either side. All
formulas are closed, so a plan is a projection over page positions: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS_AN_INCH = 72.0
MILLIMETRES_AN_INCH = 25.4


def signature_size(size: int) -> int:
    """A signature's pages: a multiple of four, four at least."""
    return max(4, size // 4 * 4)


def slots(df: DataFrame, position: str, pages: Column, size: int) -> DataFrame:
    """Adds where a page position (from 1 on) is printed: signature, depth (0 is the outer leaf),
    side and slot. `pages` is the number of pages; the last signature is padded to fours."""
    whole = signature_size(size)
    g = F.col(position) - 1
    signature = F.floor(g / whole)
    within = g % whole + 1
    rest = F.least(F.lit(whole), pages - signature * whole)
    padded = F.floor((rest + 3) / 4) * 4
    front = within * 2 <= padded
    side = F.when(front, F.when(within % 2 == 1, "back").otherwise("front")).otherwise(F.when((padded - within) % 2 == 0, "back").otherwise("front"))
    depth = F.when(front, F.floor((within - 1) / 2)).otherwise(F.floor((padded - within) / 2))
    return df.withColumns(
        {"signature": (signature + 1).cast("long"), "depth": depth.cast("long"), "side": side, "slot": F.when(front, "top").otherwise("bottom"), "blank": F.col(position) > pages}
    )


def padded_pages(pages: Column, size: int) -> Column:
    """The positions that a plan of so many pages has: the last signature filled up to fours."""
    whole = signature_size(size)
    full = F.floor(pages / whole) * whole
    return (full + F.ceil((pages - full) / 4) * 4).cast("long")


def creep(depth: Column, caliper_mm: float) -> Column:
    """How far, in points, the fold pushes a leaf of this depth outward."""
    return depth * (2 * caliper_mm * POINTS_AN_INCH / MILLIMETRES_AN_INCH)


def crop(width: Column, height: Column, recto: Column, margins: tuple[float, float, float, float], shift: Column) -> Column:
    """A page's crop as a struct left, top, right, bottom (points from the top left corner), with
    margins (inside, outside, top, bottom); the inside grows by `shift`, and a verso is mirrored.
    Null where no more than a point is left."""
    inside, outside, top, bottom = margins
    inner = F.least(F.lit(inside) + shift, width)
    left = F.when(recto, inner).otherwise(F.lit(outside))
    right = width - F.when(recto, F.lit(outside)).otherwise(inner)
    box = F.struct(left.alias("left"), F.lit(top).alias("top"), right.alias("right"), (height - bottom).alias("bottom"))
    return F.when((right - left > 1) & (height - bottom - top > 1), box)


def pixels(points: Column, dpi: float) -> Column:
    """Points as pixels, halves to even."""
    return F.bround(points * (dpi / POINTS_AN_INCH)).cast("long")


def fit(width: Column, height: Column, sheet: tuple[float, float], margin: float) -> Column:
    """The scale at which a page fits into a sheet without distortion."""
    return F.least((sheet[0] - 2 * margin) / width, (sheet[1] - 2 * margin) / height)


def top_down(low: Column, high: Column, height: Column) -> Column:
    """A box's y-up edges as fractions from the top: a struct top, bottom, in order."""
    a, b = 1 - high / height, 1 - low / height
    return F.struct(F.least(a, b).alias("top"), F.greatest(a, b).alias("bottom"))


def clock(seconds: Column) -> Column:
    """Seconds as HH:MM:SS, fractions cut."""
    whole = seconds.cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(whole / 3600)), two(F.floor(whole / 60) % 60), two(whole % 60))


def seconds(text: Column) -> Column:
    """HH:MM:SS(.fff) or MM:SS(.fff) as seconds; null for other text."""
    part = lambda g: F.regexp_extract(text, r"^(?:(\d+):)?(\d{1,3}):(\d{1,3}(?:\.\d+)?)$", g)
    return F.when(part(2) != "", F.coalesce(part(1).try_cast("double"), F.lit(0.0)) * 3600 + part(2).try_cast("double") * 60 + part(3).try_cast("double"))
