"""Correlation of wide tables against numpy."""
import numpy as np
import pytest

from quayside.operators import aggregates as A


def test_wide_skips_missing_sides_pair_by_pair(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40)) + 1e4
    x[:, 1] += x[:, 0]
    x[:, 3] = 7.0
    rows = [[None if (i + j) % 11 == 0 else float("nan") if (i * j) % 17 == 5 else float(v) for j, v in enumerate(r)]
            for i, r in enumerate(x)]
    names = [f"c{j}" for j in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    got = {(r.var1, r.var2): r.r for r in A.correlation_wide(df, names).collect()}
    assert len(got) == 40 * 39 // 2
    values = np.array([[np.nan if v is None else v for v in r] for r in rows])
    for (a, b), r in got.items():
        pair = values[:, [names.index(a), names.index(b)]]
        pair = pair[~np.isnan(pair).any(axis=1)]
        if "c3" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(pair.T)[0, 1], abs=1e-9)
    assert A.correlation_wide(df.limit(0), names[:2]).count() == 0
