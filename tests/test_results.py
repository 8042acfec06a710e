import uuid

from pyspark.sql import functions as F

from loamflow.sources.results import (MEASUREMENT_SCHEMA, append_results, append_results_table,
                                      read_results, read_results_json, write_results_json)


def _rows(spark, n=2):
    base = [None] * len(MEASUREMENT_SCHEMA.fields)
    rows = []
    for i in range(n):
        r = list(base)
        r[0], r[1], r[12] = f"c{i}", "OK", "LISTED"
        rows.append(tuple(r))
    return spark.createDataFrame(rows, MEASUREMENT_SCHEMA)


def test_catalog_append_creates_schema_and_adds_columns(spark):
    db = f"lf_{uuid.uuid4().hex[:8]}"
    table = f"{db}.drain_measurement_results"
    append_results_table(spark, _rows(spark), table)
    assert spark.catalog.databaseExists(db)
    more = _rows(spark, 1).withColumn("run_id", F.lit("r2"))
    append_results_table(spark, more, table)
    t = spark.table(table)
    assert "run_id" in t.columns and t.count() == 3
    assert t.where("run_id = 'r2'").count() == 1


def test_parquet_and_json_results(spark, run_dir):
    append_results(_rows(spark), f"{run_dir}/results")
    append_results(_rows(spark, 1).withColumn("extra", F.lit(1)), f"{run_dir}/results")
    r = read_results(spark, f"{run_dir}/results")
    assert r.count() == 3 and "extra" in r.columns
    write_results_json(_rows(spark).withColumn("measured_at_utc", F.current_timestamp()),
                       f"{run_dir}/json")
    back = read_results_json(spark, f"{run_dir}/json")
    types = dict(back.dtypes)
    assert types["drain_seconds"] == "double" and types["measured_at_utc"] == "timestamp"
