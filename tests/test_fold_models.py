"""Walk-forward fold models: the keyed fold table, its scalers, and predictions fold by fold."""
import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harvestframe.config import Config, ModelConfig
from harvestframe.plans import train as T

FEATS = ["a", "b"]
CFG = replace(Config(), model=replace(ModelConfig(), n_cv_splits=3, gap_days=2, max_iter=4, max_depth=2))


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    parts = []
    for s, n in (("x", 120), ("y", 90)):
        a, b = rng.normal(0, 1, n), rng.normal(0, 3, n)
        parts.append(pd.DataFrame({"symbol": s, "date": [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(n)],
                                   "a": a, "b": b, "target": 2 * a + rng.normal(0, 0.1, n)}))
    return pd.concat(parts)


def test_folds_are_scaled_by_their_own_training_rows(spark, frame):
    got = T.fold_rows(spark.createDataFrame(frame), FEATS, CFG).toPandas()
    assert sorted(got["fold"].unique()) == [1, 2, 3]
    for (s, k), sub in got.groupby(["symbol", "fold"]):
        own = frame[frame.symbol == s].reset_index(drop=True)
        n = len(own) - int(len(own) * CFG.model.test_size)
        end = n // 4 * k
        tr = sub[sub.role == "train"].sort_values("date")
        assert list(tr.date) == list(own.date[:end]) and set(sub.train_end) == {end}
        va = sub[sub.role == "val"].sort_values("date")
        assert list(va.date) == list(own.date[end + 2:min(end + 2 + n // 4, n)])
        q = np.percentile(own.a[:end], [25, 50, 75])
        np.testing.assert_allclose(va.a, (own.a[end + 2:end + 2 + len(va)] - q[1]) / (q[2] - q[0]), rtol=1e-12)


def test_side_by_side_fits_equal_fits_in_turn(spark, frame):
    df = spark.createDataFrame(frame)
    both = [T.fold_predictions(df, FEATS, CFG, side_by_side=n).orderBy("symbol", "fold", "date").toPandas() for n in (3, 1)]
    assert len(both[0]) > 60
    pd.testing.assert_frame_equal(*both)
    assert np.corrcoef(both[0].target, both[0].prediction)[0, 1] > 0.7


def test_cross_validate_summarises_the_folds_and_takes_no_rows(spark, frame):
    df = spark.createDataFrame(frame)
    got = {r["metric"]: r for r in T.cross_validate(df, FEATS, CFG).collect()}
    p = T.fold_predictions(df, FEATS, CFG).toPandas()
    mae = p.groupby("fold").apply(lambda d: (d.target - d.prediction).abs().mean(), include_groups=False)
    assert abs(got["mae"]["mean"] - mae.mean()) < 1e-9 and abs(got["mae"]["std"] - mae.std()) < 1e-9
    assert T.fold_predictions(df.where(F.lit(False)), FEATS, CFG).count() == 0
