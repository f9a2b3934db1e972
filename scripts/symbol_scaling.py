"""Gold build time vs number of series: the sf silver replicated K times under new symbols.

usage: python scripts/symbol_scaling.py [sf_dir] [K ...]   (prints one line per K)
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from harvestframe.plans.gold import build_gold  # noqa: E402
from harvestframe.queries_core import silver  # noqa: E402
from harvestframe.session import build_session, shared_dir  # noqa: E402


def replicated(s, k: int):
    """k copies of every series, each copy a new symbol (data derived from the tables)."""
    copies = s.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return copies.withColumn("symbol", F.concat_ws("#", "symbol", F.col("__copy").cast("string"))).drop("__copy")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(x) for x in sys.argv[2:]] or [1, 10]
    spark = build_session("local[8]", shuffle_partitions=16)
    shared_dir(spark)
    s = silver(spark, sf).checkpoint(eager=True)
    for k in ks:
        src = replicated(s, k).checkpoint(eager=True)
        n = src.count()
        t = time.time()
        build_gold(src).write.format("noop").mode("overwrite").save()
        el = time.time() - t
        print(f"K={k} series={5 * k} rows={n} gold_sec={el:.2f} rows_per_sec={n / el:,.0f}", flush=True)


if __name__ == "__main__":
    main()
