"""Run the whole job on stored tables.

python -m tidemark --long PATH --vacc PATH --out DIR [--method ridge]

Tables are Parquet paths or catalog names. Layers are written below --out as
versioned tables, which a job may replace while others read them; sources/versions.py
and sources/staging.py (load) read them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark import schemas as S
from tidemark.operators import models
from tidemark.plans.pipeline import Pipeline
from tidemark.sources import staging
from tidemark.sources.layers import LayerStore


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    parser.add_argument("--long", required=True, help="long event table")
    parser.add_argument("--vacc", required=True, help="table of vaccination measures")
    parser.add_argument("--out", required=True, help="directory for the layers")
    parser.add_argument("--key-map", help="table (source_name, second_name); default built in")
    parser.add_argument("--exclude", nargs="*", default=list(S.DEFAULT_EXCLUDED))
    parser.add_argument("--method", choices=models.METHODS, default="ridge")
    parser.add_argument("--horizon", type=int, default=30)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    keys = staging.load(spark, args.key_map) if args.key_map else staging.key_map(spark)
    Pipeline(
        staging.stage_long(staging.load(spark, args.long)),
        staging.stage_vacc(staging.load(spark, args.vacc)),
        keys,
        exclude=args.exclude,
        method=args.method,
        horizon=args.horizon,
        store=LayerStore(spark, args.out),
    ).build()


if __name__ == "__main__":
    main()
