"""Boxes on pages: words in layout boxes, and statistics of pixels.

Images are decoded elsewhere; pixels come in as arrays of 0 to 255 or as counts of values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StructField, StructType

SLACK = 0.005  # how far a centre may lie outside a box
PARTS = 4  # of a page's words, by their names; its boxes go to each
PAIRS = 1 << 16  # of points and boxes that are compared at once


def first_around(x: np.ndarray, y: np.ndarray, left: np.ndarray, top: np.ndarray, right: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """The number of the first box around each point, edges included; -1 where there is none.

    Points are parted at medians, and each part keeps the boxes that reach into it, up to the
    first that holds it whole, so that few pairs of a point and a box are ever compared. Places
    count by rank, in Spark's order: NaN equals itself and is above all else.
    """
    ranks, spans = [], []
    for at, low, high in ((x, left, right), (y, top, bottom)):
        order = np.argsort(at, kind="stable")
        rank = np.empty(len(at), np.int64)
        rank[order] = np.arange(len(at))
        ranks.append(rank)
        spans += [np.searchsorted(at[order], low, "left"), np.searchsorted(at[order], high, "right") - 1]
    (px, py), (x0, x1, y0, y1) = ranks, spans
    first = np.full(len(x), -1, np.int64)
    parts = [(np.arange(len(x)), np.arange(len(left)))] if len(x) else []
    while parts:
        points, near = parts.pop()
        u, v = px[points], py[points]
        ua, ub, va, vb = u.min(), u.max(), v.min(), v.max()
        near = near[(x0[near] <= ub) & (x1[near] >= ua) & (y0[near] <= vb) & (y1[near] >= va)]
        whole = (x0[near] <= ua) & (x1[near] >= ub) & (y0[near] <= va) & (y1[near] >= vb)
        if whole.any():
            near = near[: whole.argmax() + 1]
        if len(points) * len(near) > PAIRS:
            along = u if ub - ua >= vb - va else v
            low = along < np.partition(along, len(along) // 2)[len(along) // 2]
            parts += [(points[low], near), (points[~low], near)]
        elif len(near):
            u, v = u[:, None], v[:, None]
            inside = (x0[near] <= u) & (x1[near] >= u) & (y0[near] <= v) & (y1[near] >= v)
            first[points] = np.where(inside.any(1), near[inside.argmax(1)], -1)
    return first


def _placed(words: pa.Table, boxes: pa.Table) -> pa.Table:
    """A part of a page's words with the smallest of the page's boxes around each."""
    boxes = boxes.take(pc.sort_indices(boxes, [("_area", "ascending"), ("_box", "ascending")])).combine_chunks()
    edges = [boxes[c].to_numpy() for c in ("_l", "_t", "_r", "_b")]
    names = words["_word"].combine_chunks().dictionary_encode()
    known = np.flatnonzero(pc.and_(words["_x"].is_valid(), pc.and_(words["_y"].is_valid(), words["_word"].is_valid())).to_numpy())
    first = first_around(*(words[c].take(known).to_numpy() for c in ("_x", "_y")), *edges)
    # Rows of the same word share the smallest box around any of them.
    code = pc.fill_null(names.indices, len(names.dictionary)).to_numpy()
    best = np.full(len(names.dictionary) + 1, boxes.num_rows, np.int64)
    np.minimum.at(best, code[known], np.where(first < 0, boxes.num_rows, first))
    at = best[code]
    box = boxes["_box"].take(pa.array(at, mask=at == boxes.num_rows))
    return pa.table([words["_own"], words["_word"], box], ["_own", "_word", "_box"])


def smallest_box(words: DataFrame, boxes: DataFrame, page: str, word: str, box: str, slack: float = SLACK) -> DataFrame:
    """page, word, box: each word (page, word, x, y of its centre) with the smallest box (page, box,
    l, t, r, b) around it; of equally small ones the first; null where there is none. Each of a
    page's PARTS of words meets the page's boxes in one Arrow group, where `first_around` compares few pairs."""
    # Both sides need pages of one type to be grouped in the same places.
    kind = words.select(page).union(boxes.select(page)).schema[0].dataType
    d = lambda c: c.cast("double")
    area = (F.col("r") - F.col("l")) * (F.col("b") - F.col("t"))
    held = boxes.select(
        F.col(page).cast(kind).alias("_page"), F.col(box).alias("_box"), F.round(area, 9).alias("_area"),
        d(F.col("l") - slack).alias("_l"), d(F.col("t") - slack).alias("_t"), d(F.col("r") + slack).alias("_r"), d(F.col("b") + slack).alias("_b"),
    ).where("_page is not null and _l is not null and _t is not null and _r is not null and _b is not null")
    held = held.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.pmod(F.xxhash64(word), F.lit(PARTS)).cast("int")
    centres = words.select(F.col(page).cast(kind).alias("_page"), part.alias("_part"), F.col(page).alias("_own"), F.col(word).alias("_word"), d(F.col("x")).alias("_x"), d(F.col("y")).alias("_y"))
    kinds = StructType([StructField("_own", words.schema[page].dataType), StructField("_word", words.schema[word].dataType), StructField("_box", boxes.schema[box].dataType)])
    found = centres.groupBy("_page", "_part").cogroup(held.groupBy("_page", "_part")).applyInArrow(_placed, kinds)
    return found.select(F.col("_own").alias(page), F.col("_word").alias(word), F.col("_box").alias(box))


def counts_of_values(df: DataFrame, keys: Sequence[str], pixels: str) -> DataFrame:
    """keys, value, n: how often each value occurs among a row's pixels."""
    return df.select(*keys, F.explode(pixels).alias("value")).groupBy(*keys, "value").agg(F.count("*").alias("n"))


def levels(counted: DataFrame, keys: Sequence[str], low: float, high: float) -> DataFrame:
    """keys, black, white: the first values at which the share of pixels reaches `low` and `high`."""
    window = Window.partitionBy(*keys)
    upto = F.sum("n").over(window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumns({"_upto": upto, "_all": F.sum("n").over(window)})
    first = lambda share: F.min(F.when(F.col("_upto") >= F.col("_all") * share, F.col("value")))
    return placed.groupBy(*keys).agg(first(low).alias("black"), first(high).alias("white"))


def stretched(value: Column, black: Column, white: Column) -> Column:
    """A value on the scale from black to white as 0 to 255; unchanged where both are the same."""
    moved = F.bround((value - black) * 255 / F.nullif(white - black, F.lit(0)), 0)
    return F.when(white == black, value).otherwise(F.greatest(F.lit(0), F.least(F.lit(255), moved))).cast("int")


def channel_spread(red: str, green: str, blue: str) -> Column:
    """The larger mean difference of neighbouring colour channels, given as arrays."""
    apart = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x) / F.size(a)
    return F.greatest(apart(red, green), apart(green, blue))


def laplacian_variance(image: np.ndarray) -> float:
    """The variance of the five-point Laplacian: low for blurred images."""
    p = image.astype(float)
    inner = 4 * p[1:-1, 1:-1] - p[:-2, 1:-1] - p[2:, 1:-1] - p[1:-1, :-2] - p[1:-1, 2:]
    return float(inner.var()) if inner.size else 0.0


def skew_angle(image: np.ndarray, most: float = 2.5, step: float = 0.2, ink: int = 500) -> float:
    """The angle, in degrees, at which rows of ink are sharpest; 0 with too little ink."""
    ys, xs = np.nonzero(image < 128)
    if len(ys) <= ink:
        return 0.0
    best = (-1.0, 0.0)
    for angle in np.arange(-most, most + step / 2, step):
        rows = np.round(ys - xs * np.tan(np.radians(angle))).astype(int)
        profile = np.bincount(rows - rows.min())
        energy = float((np.diff(profile.astype(float)) ** 2).sum())
        best = max(best, (energy, float(angle)))
    return round(best[1], 6)


def of_image(function):
    """A function of images as an expression of a pixel array and a width."""

    @pandas_udf(DoubleType())
    def measured(pixels: pd.Series, width: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else function(np.asarray(p).reshape(-1, int(w))) for p, w in zip(pixels, width)])

    return measured
