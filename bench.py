"""Bench: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each job is forced with a ``noop`` write (full execution, no collect).
The bars use the 150-ticker domain (brand x type).  Every job runs
``$BENCH_PASSES`` times (default 2); the reported value is the last (warm)
pass, the first (cold) pass is reported alongside.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bourse.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="bourse-bench")
    from bourse import queries_catalog as qc
    from bourse.plans import fundamentals as fu
    from bourse.plans import momentum as mom
    from bourse.plans import patterns as pat
    from bourse.plans import price
    from bourse.plans import dataset as ds
    from bourse.sources import tables as src

    tk = "brand_type"

    def bars():
        return src.bars(spark, sf_dir, tk)

    jobs = {
        "bars": lambda: bars(),
        "price_features": lambda: price.price_features(bars()),
        "momentum": lambda: mom.momentum_daily(price.by_ticker(bars())),
        "patterns": lambda: pat.patterns_daily(price.by_ticker(bars())),
        "fundamentals": lambda: qc._fund(spark, sf_dir, tk),
        "full_dataset": lambda: qc.full_dataset_query(spark, sf_dir, tk),
        "preprocess": lambda: ds.preprocess(qc.complete_dataset_query(spark, sf_dir, tk)),
    }
    only = os.environ.get("BENCH_ONLY")
    if only:
        jobs = {k: v for k, v in jobs.items() if k in only.split(",")}
    passes = int(os.environ.get("BENCH_PASSES", "2"))
    runs: dict[str, list[float]] = {name: [] for name in jobs}
    for _ in range(passes):
        for name, build in jobs.items():
            t0 = time.time()
            build().write.format("noop").mode("overwrite").save()
            runs[name].append(round(time.time() - t0, 3))
    # the first pass carries JVM start-up, class loading and codegen warm-up;
    # the reported time per job is its last (warm) pass
    times = {name: r[-1] for name, r in runs.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_wall_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "tickers": tk,
        "passes": passes,
        "first_pass": {name: r[0] for name, r in runs.items()},
    }
    print(json.dumps(out))
    _ = fu
    spark.stop()


if __name__ == "__main__":
    main()
