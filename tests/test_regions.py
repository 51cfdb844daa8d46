"""Unions of boxes against a fine grid."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflux.operators import regions


@pytest.mark.parametrize("block", [3.0, 4.0, 100.0])
def test_union_equals_a_fine_grid(spark, block):
    r = np.random.default_rng(1)
    rows, grids = [], {}
    for g in range(3):
        full = np.zeros((24, 24), bool)
        for _ in range(12):
            w, s = (int(v) for v in r.integers(0, 18, 2))
            e, n = w + int(r.integers(0, 6)), s + int(r.integers(1, 6))
            rows.append((g, float(w), float(s), float(e), float(n)))
            full[s:n, w:e] = True
        grids[g] = full
    rows += [rows[0], (0, None, 1.0, 2.0, 3.0), (9, 5.0, 5.0, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "group int, W double, S double, E double, N double").repartition(3)
    assert {x["group"]: x["area"] for x in regions.areas(df, block).collect()} == {g: float(f.sum()) for g, f in grids.items()}
    cells = {}
    for x in regions.strips(df, block).collect():
        for y in range(int(x["S"]), int(x["N"])):
            for k in range(int(x["W"]), int(x["E"])):
                assert cells.setdefault((x["group"], y, k), x) is x  # strips do not overlap
    assert set(cells) == {(g, int(y), int(k)) for g, f in grids.items() for y, k in zip(*np.nonzero(f))}
    got = set()
    for x in regions.outline(df, block).collect():
        a, b = np.array([x["x0"], x["y0"]]), np.array([x["x1"], x["y1"]])
        n = int(np.abs(b - a).max())
        for k in range(n):
            p, q = a + (b - a) * k / n, a + (b - a) * (k + 1) / n
            unit = (x["group"], *p, *q)
            assert unit not in got
            got.add(unit)
    want = set()
    for g, f in grids.items():
        p = np.pad(f, 1)
        for y, k in zip(*np.nonzero(f)):
            if not p[y, k + 1]:
                want.add((g, k, y, k + 1, y))  # the covered side above: eastwards
            if not p[y + 2, k + 1]:
                want.add((g, k + 1, y + 1, k, y + 1))
            if not p[y + 1, k]:
                want.add((g, k, y + 1, k, y))
            if not p[y + 1, k + 2]:
                want.add((g, k + 1, y, k + 1, y + 1))
    assert got == {(g, *map(float, rest)) for g, *rest in want}


def test_no_boxes(spark):
    none = spark.createDataFrame([], "group int, W double, S double, E double, N double")
    assert regions.areas(none, 1.0).count() == 0 and regions.outline(none, 1.0).agg(F.count("*")).head()[0] == 0
