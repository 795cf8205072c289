from conftest import SF
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.sources import staging, tpch


def test_the_job_writes_all_layers(spark, tmp_path):
    raw = {"long": tpch.raw_long(spark, SF), "vacc": tpch.raw_vacc(spark, SF)}
    for name, df in raw.items():
        df.toDF(*[c.upper() for c in df.columns]).write.parquet(f"{tmp_path}/{name}")
    tpch.nation_key_map(spark, SF).write.parquet(f"{tmp_path}/keys")
    main([
        "--long", f"{tmp_path}/long", "--vacc", f"{tmp_path}/vacc", "--out", f"{tmp_path}/out",
        "--key-map", f"{tmp_path}/keys", "--exclude", "NATION_24",
        "--method", "seasonal_naive", "--horizon", "14",
    ])
    marts = f"{tmp_path}/out/marts"
    output = staging.load(spark, f"{marts}/forecast_output_seasonal_naive")
    counts = output.groupBy("country_region").agg(
        F.sum(F.col("is_forecast").cast("int")).alias("n")
    )
    assert {r.n for r in counts.collect()} == {14} and counts.count() == 24
    texts = staging.load(spark, f"{marts}/outbreak_narratives_seasonal_naive")
    assert texts.count() == 24 and "generated_at" in texts.columns
