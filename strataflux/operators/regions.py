"""Unions of boxes, without a task that sees them all.

Boxes are cut at the lines of a grid of blocks. A block sweeps over the sorted edges of its own pieces, which gives the union as strips that do
not overlap, and the outline of what it covers. Where two blocks meet, the outlines of both sides lie on the line between them; what both cover
cancels there, piece by piece. The outline has the covered side on its left.

Boxes are rows (group, W, S, E, N); ones without an area, or with nulls, count for nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

_BOX = ["W", "S", "E", "N"]


def _pieces(boxes: DataFrame, block: float) -> DataFrame:
    """Each box in the blocks that it meets, cut to them."""
    whole = boxes.select("group", *(F.col(c).cast("double").alias(c) for c in _BOX)).where("E > W and N > S").distinct()
    steps = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / block), F.ceil(F.col(hi) / block) - 1))
    dealt = whole.withColumn("i", steps("W", "E")).withColumn("j", steps("S", "N"))
    return dealt.select(
        "group", "i", "j", F.greatest("W", F.col("i") * block).alias("W"), F.greatest("S", F.col("j") * block).alias("S"), F.least("E", (F.col("i") + 1) * block).alias("E"), F.least("N", (F.col("j") + 1) * block).alias("N"),
    ).where("E > W and N > S").distinct()


def covered(own: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted edges along both axes, and which of the cells between them are covered (rows by y, columns by x)."""
    xs, ys = np.unique(own[["W", "E"]].to_numpy()), np.unique(own[["S", "N"]].to_numpy())
    step = np.zeros((len(ys), len(xs)), int)
    at = [np.searchsorted(e, own[c].to_numpy()) for c, e in (("W", xs), ("E", xs), ("S", ys), ("N", ys))]
    for x, y, d in ((at[0], at[2], 1), (at[1], at[3], 1), (at[0], at[3], -1), (at[1], at[2], -1)):
        np.add.at(step, (y, x), d)
    return xs, ys, step.cumsum(0).cumsum(1)[:-1, :-1] > 0


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and one past the last of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def strips(boxes: DataFrame, block: float) -> DataFrame:
    """group, W, S, E, N: the union of a group's boxes as boxes that do not overlap."""

    def run(own: pd.DataFrame) -> pd.DataFrame:
        xs, ys, full = covered(own)
        rows = [(own["group"].iloc[0], xs[a], ys[k], xs[b], ys[k + 1]) for k, line in enumerate(full) for a, b in _runs(line)]
        return pd.DataFrame(rows, columns=["group", *_BOX])

    kind = boxes.schema["group"].dataType.simpleString()
    return _pieces(boxes, block).groupBy("group", "i", "j").applyInPandas(run, f"group {kind}, W double, S double, E double, N double")


def areas(boxes: DataFrame, block: float) -> DataFrame:
    """group and the area of its boxes' union."""
    return strips(boxes, block).groupBy("group").agg(F.sum((F.col("E") - F.col("W")) * (F.col("N") - F.col("S"))).alias("area"))


def outline(boxes: DataFrame, block: float) -> DataFrame:
    """group, x0, y0, x1, y1: straight pieces of the union's outline, holes included, each with the covered side on its left."""
    kind = boxes.schema["group"].dataType.simpleString()

    def run(own: pd.DataFrame) -> pd.DataFrame:
        xs, ys, full = covered(own)
        framed = np.pad(full, 1).astype(int)
        rows = []
        # Along x: covered above (left of a step to the east) or below. Along y: covered to the west (left of a step north) or east.
        for axis, lines, ends, change in (("x", ys, xs, np.diff(framed, axis=0)[:, 1:-1]), ("y", xs, ys, -np.diff(framed, axis=1)[1:-1].T)):
            for k, line in enumerate(change):
                for sign in (1, -1):
                    rows += [(own["group"].iloc[0], axis, lines[k], ends[a], ends[b], sign) for a, b in _runs(line == sign)]
        return pd.DataFrame(rows, columns=["group", "axis", "at", "lo", "hi", "sign"])

    def cancel(own: pd.DataFrame) -> pd.DataFrame:
        ends = np.unique(own[["lo", "hi"]].to_numpy())
        step = np.zeros(len(ends), int)
        np.add.at(step, np.searchsorted(ends, own["lo"].to_numpy()), own["sign"].to_numpy())
        np.add.at(step, np.searchsorted(ends, own["hi"].to_numpy()), -own["sign"].to_numpy())
        net = step.cumsum()[:-1]
        one = own.iloc[0]
        rows = [(one["group"], one["axis"], one["at"], ends[a], ends[b], sign) for sign in (1, -1) for a, b in _runs(net == sign)]
        return pd.DataFrame(rows, columns=["group", "axis", "at", "lo", "hi", "sign"])

    schema = f"group {kind}, axis string, at double, lo double, hi double, sign int"
    each = _pieces(boxes, block).groupBy("group", "i", "j").applyInPandas(run, schema)
    # What lies on a line between blocks meets what the other side has there: pieces of one line within one block's length.
    line = F.round(F.col("at") / block)
    on_line = line * block == F.col("at")
    near = each.where(on_line).withColumn("part", F.floor((F.col("lo") + F.col("hi")) / 2 / block))
    met = near.groupBy("group", "axis", "at", "part").applyInPandas(lambda own: cancel(own), schema)
    out, east = each.where(~on_line).unionByName(met), F.col("sign") == 1
    first, last = F.when(east, F.col("lo")).otherwise(F.col("hi")), F.when(east, F.col("hi")).otherwise(F.col("lo"))
    along = F.col("axis") == "x"
    return out.select(
        "group", F.when(along, first).otherwise(F.col("at")).alias("x0"), F.when(along, F.col("at")).otherwise(first).alias("y0"), F.when(along, last).otherwise(F.col("at")).alias("x1"), F.when(along, F.col("at")).otherwise(last).alias("y1"),
    )
