import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from harvestframe.session import build_session
    s = build_session("local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def silver_pdf():
    import pandas as pd
    from series import SILVER_ORDER, synthetic_silver
    return pd.concat([synthetic_silver(seed=42, symbol="corn"), synthetic_silver(seed=7, symbol="oats")])[SILVER_ORDER]


@pytest.fixture(scope="session")
def gold_pdf(spark, silver_pdf):
    from harvestframe.plans.gold import build_gold
    return build_gold(spark.createDataFrame(silver_pdf)).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
