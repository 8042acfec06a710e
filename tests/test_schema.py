import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamflow.functions import schema as S


def test_widen_and_evolve():
    assert S.widen(T.IntegerType(), T.LongType()) == T.LongType()
    assert S.widen(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert S.widen(T.LongType(), T.StringType()) == T.StringType()
    tracked = T.StructType([T.StructField("a", T.LongType())])
    obs = [T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())]),
           T.StructType([T.StructField("n", T.LongType()), T.StructField("m", T.BooleanType())])]
    out = S.evolve(tracked, obs)
    assert [(f.name, f.dataType) for f in out.fields] == [
        ("a", T.LongType()), ("n", T.LongType()), ("m", T.BooleanType())]


def test_align_and_rescue(spark):
    tracked = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()),
                            T.StructField("c", T.StringType())])
    df = spark.createDataFrame([("1", 2.5, True, "x.parquet"), ("oops", 3.0, None, "x.parquet"),
                                (None, 4.25, False, "x.parquet")],
                               "a string, b double, n2 boolean, __loamflow_file string")
    rows = S.align_and_rescue(df, tracked).collect()
    assert [(r.a, r.b, r.c) for r in rows] == [(1, 2.5, None), (None, 3.0, None), (None, 4.25, None)]
    assert [json.loads(r._rescued_data) if r._rescued_data else None for r in rows] == [
        {"n2": True}, {"a": "oops"}, {"n2": False}]
    assert rows[0]["__loamflow_file"] == "x.parquet"


def test_non_text_round_trip_rule(spark):
    tracked = T.StructType([T.StructField("a", T.LongType())])
    df = spark.createDataFrame([(6.55,), (7.0,)], "a double")
    rows = S.align_and_rescue(df, tracked).collect()
    assert [(r.a, r._rescued_data) for r in rows] == [(None, '{"a":6.55}'), (7, None)]


def test_infer_text_types(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "x", None, "007", "2025-01-02T03:04:05Z", "2024"),
                                ("-2", "2", "False", "1", None, "8", "2025-01-02 03:04", "2025")],
                               "i string, d string, b string, s string, z string, p string, "
                               "t string, y string")
    got = S.infer_text_types(df, df.columns)
    assert got == {"i": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(),
                   "s": T.StringType(), "z": T.StringType(), "p": T.LongType(),
                   "t": T.TimestampType(), "y": T.LongType()}


def test_schema_store(spark, run_dir):
    st = S.SchemaStore(spark, f"{run_dir}/schemas/x")
    assert st.latest() is None and st.version() == 0
    s1 = T.StructType([T.StructField("a", T.LongType())])
    st.save(s1, 0)
    s2 = T.StructType(s1.fields + [T.StructField("b", T.StringType())])
    st.save(s2, 3)
    fresh = S.SchemaStore(spark, f"{run_dir}/schemas/x")
    assert fresh.latest() == s2 and fresh.version() == 2
    assert fresh.history().count() == 2


def test_nested_evolution_and_alignment(spark):
    s1 = T.StructType([T.StructField("doc", T.StructType([T.StructField("x", T.LongType())])),
                       T.StructField("items", T.ArrayType(T.StructType([T.StructField("k", T.StringType())])))])
    s2 = T.StructType([T.StructField("doc", T.StructType([T.StructField("x", T.LongType()),
                                                          T.StructField("y", T.StringType())])),
                       T.StructField("items", T.ArrayType(T.StructType([T.StructField("k", T.StringType()),
                                                                        T.StructField("v", T.LongType())])))])
    tracked = S.evolve(S.evolve(None, [s1]), [s2])
    assert tracked == s2
    old = spark.createDataFrame([({"x": 1}, [{"k": "a"}]), (None, None)], s1)
    rows = S.align_and_rescue(old, tracked).collect()
    assert rows[0].doc.asDict() == {"x": 1, "y": None}
    assert [i.asDict() for i in rows[0].items] == [{"k": "a", "v": None}]
    assert rows[0]._rescued_data is None and rows[1].doc is None and rows[1].items is None
    clash = T.StructType([T.StructField("doc", T.StructType([T.StructField("x", T.StringType())]))])
    bad = spark.createDataFrame([({"x": "oops"},)], clash)
    r = S.align_and_rescue(bad, tracked).first()
    assert r.doc is None and r._rescued_data == '{"doc":{"x":"oops"}}'


def test_schema_versions_are_ordered_by_number(spark, run_dir):
    from loamflow.sources import storage

    st = S.SchemaStore(spark, f"{run_dir}/schemas/n")
    s1 = T.StructType([T.StructField("a", T.LongType())])
    for v in (99_999, 100_000):
        storage.write(spark, st._file(v), json.dumps({"version": v, "batch_id": 0, "schema_json": s1.json()}).encode())
    assert st.version() == 100_000


def test_every_type_pair_aligns(spark):
    import datetime
    import decimal

    values = {"boolean": True, "tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 1.5, "double": 2.5,
              "decimal(10,2)": decimal.Decimal("1.25"), "string": "x", "binary": bytearray(b"xy"),
              "date": datetime.date(2024, 1, 2), "timestamp": datetime.datetime(2024, 1, 2, 3, 4, 5),
              "timestamp_ntz": datetime.datetime(2024, 1, 2, 3, 4, 5), "array<int>": [1], "struct<a:int>": (1,)}
    names = [f"c{i}" for i in range(len(values))]
    targets = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in zip(names, values))).schema
    for source, value in values.items():
        df = spark.createDataFrame([(value,), (None,)], f"v {source}").select(*[F.col("v").alias(n) for n in names])
        out = S.align_and_rescue(df, targets)
        assert out.schema.fields[:len(names)] == targets.fields
        full, empty = out.collect()
        kept = json.loads(full._rescued_data or "{}")
        assert all((full[n] is None) == (n in kept) for n in names), (source, full)
        assert empty._rescued_data is None and all(empty[n] is None for n in names)
