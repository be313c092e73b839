"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barloom import views  # noqa: E402
from barloom.catalog import QUERIES  # noqa: E402
from barloom.plans import technical  # noqa: E402
from barloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def many(spark, d, pack=None):
    """Bars per supplier: as many symbols as the scale factor gives."""
    bars = views.bars_daily(spark, d, "l_suppkey")
    return technical.all_features(bars) if pack is None else technical.compute(bars, pack)


HEADLINE = {
    "ohlcv_bars_many": lambda s, d: views.bars_daily(s, d, "l_suppkey"),
    "basic_indicators_many": lambda s, d: many(s, d, technical.basic_indicators),
    "volatility_many": lambda s, d: many(s, d, technical.volatility),
    "all_features_many": many,
    "session_bars": QUERIES["d3_rth_from_intraday"],
    "avg_cross_corr": QUERIES["d20_avg_cross_corr"],
    "sector_features": QUERIES["p7_sector_features"],
    "fx_flow_features": QUERIES["p8_fx_flow_features"],
    "daily_sentiment": QUERIES["p13_daily_sentiment"],
    "median_impute": QUERIES["k3_median_impute"],
    "master_dataset": QUERIES["p14_master_slice"],
}


def main() -> None:
    spark = local_session(CPUS, int(CPUS), "barloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    rows = views.bars_daily(spark, SF_DIR, "l_suppkey").count()  # start-up is not part of any query
    times = {}
    for name, build in HEADLINE.items():
        start = time.time()
        build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    rate = {n: round(rows / t) for n, t in times.items() if n.endswith("_many")}
    line = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1], "bars_per_sec": rate}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
