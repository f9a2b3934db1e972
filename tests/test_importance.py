import pandas as pd
import pytest
from pyspark.sql import functions as F

from harvestframe.plans import importance as P
from harvestframe.plans.lineage import dataset_digest


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1009, 5000])
def test_donors_are_a_permutation(spark, n):
    rows = spark.range(n).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(6))))
    got = rows.select("r", "id", P.donor_position(F.col("id"), F.lit(n).cast("long"), F.col("r")).alias("d")).toPandas()
    for _, g in got.groupby("r"):
        assert sorted(g.d) == list(range(n)) and (n == 1 or (g.d != g.id).any())


def test_planted_feature_leads(spark):
    """Only the planted feature matters to the label; one that the scorer ignores has importance 0."""
    rows = (spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("symbol"), F.floor(F.col("id") / 3).alias("pos"), F.lit(1000).cast("long").alias("n"),
                                     F.rand(1).alias("planted"), F.rand(2).alias("weak"), F.rand(3).alias("ignored"), F.randn(4).alias("noise")))
    rows = rows.withColumn("target", 5 * F.col("planted") + 0.1 * F.col("noise"))
    got = P.permutation_importance(rows, ["weak", "ignored", "planted"], P.linear_scorer([0.02, 0.0, 5.0]), 4).toPandas().set_index("feature")
    assert got["rank"].to_dict()["planted"] == 1 and got.importance["planted"] > 1.0
    assert got.importance["ignored"] == 0.0 and abs(got.importance["weak"]) < 0.05
    # the same by hand: pandas, donor by donor
    pdf = rows.toPandas()
    base = (pdf.target - 5 * pdf.planted - 0.02 * pdf.weak).abs().mean()
    grown = []
    for r in range(4):
        donor = (P.PRIMES[r % len(P.PRIMES)] * pdf.pos + 1 + (r * P.STEP) % 999) % 1000
        dealt = pd.DataFrame({"symbol": pdf.symbol, "pos": donor}).merge(pdf[["symbol", "pos", "planted"]], on=["symbol", "pos"], how="left").planted
        grown.append((pdf.target - 5 * dealt - 0.02 * pdf.weak).abs().mean() - base)
    assert abs(got.importance["planted"] - sum(grown) / 4) < 1e-9


def test_digest_sees_nulls_and_repeats(spark):
    df = lambda rows: dataset_digest(spark.createDataFrame(rows, "a int, b int")).first()
    rows = [(1, None), (2, 2), (3, 4)]
    assert df(rows) == df(rows[::-1])
    others = [[(None, 1), (2, 2), (3, 4)], rows + rows[:1], [(1, None), (2, 2), (2, 2)], [(1, None), (3, 4), (3, 4)], [(1, None), (4, 3), (2, 2)], []]
    assert len({tuple(df(x)) for x in [rows, *others]}) == 7
