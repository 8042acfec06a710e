from pyspark.sql import functions as F

from loamflow.functions import names as N


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_collection_of(spark):
    assert _one(spark, N.collection_of("v"), "shop.transactions") == "transactions"
    assert _one(spark, N.collection_of("v"), "a.b.c") == "b.c"
    assert _one(spark, N.collection_of("v"), "plain") == "plain"
    assert _one(spark, N.collection_of("v"), ".x") == "x"


def test_trim_topic(spark):
    assert _one(spark, N.trim_topic("v"), " \t users \n") == "users"


def test_table_and_safe_names(spark):
    assert _one(spark, N.table_name("v"), "ui-elements.v2") == "ui_elements_v2"
    assert _one(spark, N.safe_name("v"), "ui-elements v2!") == "ui_elements_v2_"


def test_file_epoch(spark):
    f = N.file_epoch_ms("v")
    assert _one(spark, f, "/x/collection=a/1735689600000_a_00_01.parquet") == 1735689600000
    assert _one(spark, f, "/x/collection=a/part-0001.parquet") is None
    assert _one(spark, f, "/x/173568960000_a.parquet") is None        # 12 digits
    assert _one(spark, f, "/x/17356896000001_a.parquet") is None      # 14 digits
    assert _one(spark, f, "/1735689600000_dir/f.parquet") == 1735689600000  # first match


def test_clean_message_and_kind(spark):
    msg = "line1\nline2 " + "x" * 300
    assert _one(spark, N.clean_message("v"), msg) == ("line1 line2 " + "x" * 300)[:160]
    k = N.failure_kind("v")
    assert _one(spark, k, "org.x.UnknownFieldException: new") == "schema_evolution"
    assert _one(spark, k, "error class new_fields_in_record_with_file_path") == "schema_evolution"
    assert _one(spark, k, "unknownfieldexception lower case") == "genuine"
    assert _one(spark, k, "boom") == "genuine"


def test_file_name_and_dates(spark):
    df = spark.createDataFrame([(1735689600000, "c", 1, 2)], "e long, c string, d int, f int")
    r = df.select(N.landing_file_name("e", "c", "d", "f", F.lit("csv")).alias("n")).first().n
    assert r == "1735689600000_c_01_02.csv"
    d = spark.createDataFrame([("2025-01-02",)], "d string").select(F.col("d").cast("date").alias("d"))
    parts = d.select(*[v.alias(k) for k, v in N.day_partition_values("d").items()],
                     N.midnight_epoch_ms("d").alias("ms")).first()
    assert (parts.year, parts.month, parts.day_of_month, parts.ms) == ("2025", "01", "02", 1735776000000)


def test_format_suffix(spark):
    strict, lenient = N.format_suffix("v", False), N.format_suffix("v", True)
    assert _one(spark, strict, "a.parquet") == "parquet"
    assert _one(spark, strict, "a.CSV") is None
    assert _one(spark, lenient, "a.CSV.GZ") == "csv"
    assert _one(spark, lenient, "a.json") is None


def test_run_token_and_wall(spark):
    assert N.run_token("pinned") == "pinned"
    assert len(N.run_token().split("_")[-1]) == 8
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, None, 3.0)], "a double, b double, c double")
    assert [r.t for r in df.select(N.total_wall("a", "b", "c").alias("t")).collect()] == [6.0, None]


def test_cast_seconds_and_errors(spark):
    df = spark.createDataFrame([(None, "x")], "drain_seconds string, name string")
    out = N.cast_seconds_to_double(df)
    assert dict(out.dtypes)["drain_seconds"] == "double"
    e = spark.createDataFrame([(None,), ("a",)], "m string")
    got = [r.r for r in e.select(N.append_error("m", F.lit("stop failed")).alias("r")).collect()]
    assert got == ["stop failed", "a; stop failed"]


def test_join_errors(spark):
    df = spark.createDataFrame([(["a: boom", "b: slow"],)], "e array<string>")
    assert df.select(N.join_errors("e").alias("r")).first().r == "a: boom | b: slow"
    assert df.select(N.join_errors("e", n=4).alias("r")).first().r == "a: b"
