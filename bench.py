"""Benchmark: builds every layer once, then times the registered queries.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (timed runs per query after
one warm-up; the best counts). Prints one JSON line. ``layer_*`` entries are
the cold builds of the materialised layers, in order; the other entries are
queries over those layers, executed in full into a no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tidemark.plans import queries as Q
from tidemark.plans.pipeline import staged
from tidemark.sources import tpch
from tidemark.sources.layers import LayerStore

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

LAYERS = [
    "panel", "profile", "features", "eval_predictions", "evaluation",
    "forecast", "output", "importance", "stats", "narratives",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    # The benchmark's own store, so that every layer is built here and timed.
    store = LayerStore(spark)
    inputs = []
    times["layer_staged_sources"] = timed(
        lambda: inputs.extend(
            staged(store, tpch.raw_long(spark, SF_DIR), tpch.raw_vacc(spark, SF_DIR))
        )
    )
    pipeline = Q.pipeline_over(spark, SF_DIR, *inputs, store)
    Q.keep(spark, SF_DIR, pipeline)
    for layer in LAYERS:
        times[f"layer_{layer}"] = timed(lambda: getattr(pipeline, layer))
    cold = sum(times.values())  # from the given tables to the last mart

    def run(query) -> None:
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    for name, query in Q.queries().items():
        run(query)
        times[name] = min(timed(lambda: run(query)) for _ in range(RUNS))

    spark.stop()
    print(json.dumps({
        "metric": "layers_and_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "cold_end_to_end": round(cold, 3),
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
