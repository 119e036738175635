"""The correlation matrix, block by block, against NumPy."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from seriesloom.operators import resampling


@pytest.mark.parametrize(("series", "periods"), [(64, 512), (2, 7)])
def test_blocks_of_any_size_give_the_same_matrix(spark, monkeypatch, series, periods):
    r = random.Random(1)
    rows = []
    for k in range(7):
        level = 1000.0
        for t in range(60):
            level *= 1 + r.gauss(0, 0.1)
            if r.random() < 0.9:
                rows.append((f"s{k}", datetime(2020, 1, 1) + timedelta(days=t), level))
    rows += [("flat", datetime(2020, 1, 1) + timedelta(days=t), 5.0) for t in range(10)] + [("short", datetime(2020, 1, 1), 1.0), ("zero", datetime(2020, 1, 1), 0.0), ("zero", datetime(2020, 1, 2), 1.0)]
    given = spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")
    growth: dict = {}
    for name, at, value in sorted(rows):
        own = growth.setdefault(name, [None, {}])
        if own[0]:
            own[1][at] = value / own[0] - 1
        own[0] = value
    monkeypatch.setattr(resampling, "BLOCK_SERIES", series)

    def gram(batches, run=resampling._gram):
        resampling.BLOCK_PERIODS = periods
        yield from run(batches)

    monkeypatch.setattr(resampling, "BLOCK_PERIODS", periods)
    monkeypatch.setattr(resampling, "_gram", gram)
    got = {(x["a"], x["b"]): (x["correlation"], x["periods"]) for x in resampling.correlations(given).collect()}
    want = {}
    names = sorted(growth)
    for a in names:
        for b in names:
            shared = sorted(growth[a][1].keys() & growth[b][1].keys())
            if a < b and shared:
                x, y = (np.array([growth[n][1][t] for t in shared]) for n in (a, b))
                flat = np.ptp(x) == 0 or np.ptp(y) == 0
                want[a, b] = (None if flat or len(shared) < 2 else float(np.corrcoef(x, y)[0, 1]), len(shared))
    assert got.keys() == want.keys()
    for pair, (c, n) in want.items():
        assert got[pair][1] == n
        if c is None:
            assert got[pair][0] is None or abs(got[pair][0]) > 1e300 or np.isnan(got[pair][0])
        else:
            assert got[pair][0] == pytest.approx(c, abs=1e-9)
    assert resampling.correlations(given.limit(0)).count() == 0
