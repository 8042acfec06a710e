import gzip
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loamflow.operators import ownership as O
from loamflow.plans.resolve import resolution_counts, resolve
from loamflow.sources import landing as L
from loamflow.sources.synth import synth_summary, synthesize
from loamflow.streaming.drain import drain, outcome_counts, report_and_raise, row_counts, specs_from_resolved
from loamflow.streaming.ingest import BatchHandler, CollectionSpec, Layout, ingest_available, read_raw, start_ingest
from loamflow.streaming.measure import count_drains, measure

DB = "db"


def _dir(root, coll, day="01", db=DB):
    d = f"{root}/source=mongo/year=2025/month=01/day={day}/database={db}/collection={coll}"
    os.makedirs(d, exist_ok=True)
    return d


def _pq(root, coll, name, data, day="01"):
    pq.write_table(pa.table(data), f"{_dir(root, coll, day)}/{name}")


def _csv(root, coll, name, text, day="01", gz=False):
    path = f"{_dir(root, coll, day)}/{name}"
    data = text.encode()
    with open(path, "wb") as f:
        f.write(gzip.compress(data) if gz else data)


def _layout(run_dir):
    return Layout(f"{run_dir}/landing", DB, f"{run_dir}/raw", f"{run_dir}/ckpt")


def test_synthesize_resolve_drain(spark, run_dir):
    lay = _layout(run_dir)
    manifest = synthesize(spark, lay.source_root, DB, f"{run_dir}/manifest")
    summ = {r.collection: (r.files, r.rows) for r in synth_summary(manifest).collect()}
    assert summ[None] == (90, 18000)
    assert all(summ[c] == (15, 3000) for c in summ if c is not None)
    names = [r.file_name for r in L.list_landing(spark, lay.source_root, DB).collect()]
    assert len(names) == 90 and all(len(n.split("_", 1)[0]) == 13 for n in names)
    resolved = resolve(spark, lay.source_root, DB)
    counts = resolution_counts(resolved).first()
    assert (counts.selected, counts.parents, counts.children, counts.csv, counts.parquet) == (6, 5, 1, 1, 5)
    child = resolved.where("collection = 'transactions_statuslogs'").first()
    assert (child.owner, child.tier, child.format) == ("transactions", "high", "parquet")
    specs = specs_from_resolved(resolved)
    outcomes, _ = drain(spark, specs, lay, max_concurrent=3)
    report_and_raise(outcomes)
    assert outcome_counts(outcomes).first().ok == 6
    assert {r.collection: r.n for r in row_counts(spark, lay, specs).collect()} == {
        s.collection: 3000 for s in specs}
    vk = read_raw(spark, lay, "videokycs")
    assert dict(vk.dtypes)["attemptCount"] == "bigint"
    a = vk.agg(F.min("attemptCount"), F.max("attemptCount")).first()
    assert 1 <= a[0] <= a[1] <= 5
    tx = read_raw(spark, lay, "transactions")
    chk = tx.agg(
        F.min("amount").alias("lo"), F.max("amount").alias("hi"),
        F.count_if(F.round("amount", 2) != F.col("amount")).alias("not2dp"),
        F.count_if(~F.col("status").isin("PENDING", "COMPLETED", "FAILED", "REVERSED")).alias("badst"),
        F.count_if(~F.col("_id").rlike("^txn_[1-9][0-9]{5}$")).alias("badid"),
        F.count_if(~F.col("userId").rlike("^usr_[1-9][0-9]{4}$")).alias("badusr"),
        F.min("ts").alias("ts0"), F.max("ts").alias("ts1")).first()
    assert 10.0 <= chk.lo <= chk.hi <= 50000.0
    assert (chk.not2dp, chk.badst, chk.badid, chk.badusr) == (0, 0, 0, 0)
    day0 = 1735689600000                                   # 2025-01-01 UTC
    assert day0 <= chk.ts0 and chk.ts1 <= day0 + 2 * 86400000 + 3600000
    otp = read_raw(spark, lay, "otps")
    assert dict(otp.dtypes)["verified"] == "boolean"
    assert otp.where(~F.col("phone").rlike("^9[0-9]{9}$")).count() == 0
    assert vk.where("_file_epoch_ms IS NULL OR _rescued_data IS NOT NULL").count() == 0
    # rerun without new files: nothing new
    outcomes2, _ = drain(spark, specs, lay)
    assert outcomes2.agg(F.sum("files")).first()[0] == 0
    assert row_counts(spark, lay, specs).agg(F.sum("n")).first()[0] == 18000


def test_csv_header_drift_and_new_column_same_batch(spark, run_dir):
    lay = _layout(run_dir)
    _csv(lay.source_root, "c", "1735689600000_c_00_00.csv", "a,b\n1,x\n2,y\n")
    _csv(lay.source_root, "c", "1735689600001_c_00_01.csv", "b,a,n\nz,3,true\n")
    ingest_available(spark, CollectionSpec("c", "c", "csv"), lay)
    rows = sorted((r.a, r.b, r.n) for r in read_raw(spark, lay, "c").collect())
    assert rows == [(1, "x", None), (2, "y", None), (3, "z", True)]


def test_csv_type_is_that_of_all_rows_in_one_pass_or_two(spark, run_dir, monkeypatch):
    from loamflow.streaming import ingest as In

    def not_now(*_a):
        raise AssertionError("a batch was kept, or a guess made for nothing")

    monkeypatch.setattr(In, "GUESS_ROWS", 2)
    monkeypatch.setattr(type(spark.range(1)), "persist", not_now)
    writes, real = [], In.BatchHandler._write

    def write(self, frames, tracked, new, batch_id):
        writes.append([f.dataType.simpleString() for f in tracked.fields])
        return real(self, frames, tracked, new, batch_id)
    monkeypatch.setattr(In.BatchHandler, "_write", write)
    lay = _layout(run_dir)
    spec = CollectionSpec("ty", "ty", "csv")
    # by its first rows n is bigint and e has no value; a later row and another header say otherwise
    _csv(lay.source_root, "ty", "1735689600000_ty_00_00.csv", "n,e,same\n1,,1\n2,,2\n2.5,true,3\n")
    _csv(lay.source_root, "ty", "1735689600001_ty_00_01.csv", "n,E\n7,FALSE\n8,\n9,True\n")
    ingest_available(spark, spec, lay)
    assert len(writes) == 2 and writes[1] == ["double", "boolean", "bigint"]  # a wrong guess costs one more pass
    got = sorted(((r.n, r.E, r.same, r._rescued_data) for r in read_raw(spark, lay, "ty").collect()), key=str)
    assert got == sorted([(1.0, None, 1, None), (2.0, None, 2, None), (2.5, True, 3, None), (7.0, False, None, None),
                          (8.0, None, None, None), (9.0, True, None, None)], key=str)
    # a right guess costs none; nothing new, no guess
    _csv(lay.source_root, "ty", "1735689600002_ty_00_02.csv", "n,late\n1,2024-01-01T00:00:00Z\n")
    _csv(lay.source_root, "ty", "1735689600003_ty_00_03.csv", "n,none\n")
    ingest_available(spark, spec, lay)
    assert writes[2:] == [["double", "boolean", "bigint", "timestamp", "string"]]
    monkeypatch.setattr(In, "guess_text_types", not_now)
    _csv(lay.source_root, "ty", "1735689600004_ty_00_04.csv", "n\nx\n")
    ingest_available(spark, spec, lay)
    assert len(writes) == 4
    assert read_raw(spark, lay, "ty").where("_rescued_data = '{\"n\":\"x\"}'").count() == 1


def test_evolution_across_batches_and_rescue(spark, run_dir):
    lay = _layout(run_dir)
    _pq(lay.source_root, "p", "1735689600000_p_00_00.parquet", {"a": pa.array([1, 2], pa.int32())})
    spec = CollectionSpec("p", "p", "parquet")
    ingest_available(spark, spec, lay)
    _pq(lay.source_root, "p", "1735689700000_p_00_01.parquet",
        {"a": pa.array([3], pa.int64()), "n": ["new"]})
    _pq(lay.source_root, "p", "1735689800000_p_00_02.parquet", {"a": ["oops", "12"]})
    ingest_available(spark, spec, lay)
    df = read_raw(spark, lay, "p")
    assert [f.name for f in df.schema.fields][:2] == ["a", "n"]
    rows = sorted(((r.a, r.n, r._rescued_data) for r in df.collect()), key=str)
    assert rows == sorted([(1, None, None), (2, None, None), (3, "new", None),
                           (None, None, '{"a":"oops"}'), (12, None, None)], key=str)


def test_lineage_epoch_and_space_in_path(spark, run_dir):
    lay = _layout(run_dir)
    _pq(lay.source_root, "s", "no epoch here.parquet", {"a": [1]})
    _pq(lay.source_root, "s", "1735689600000_s_00_00.parquet", {"a": [2]})
    ingest_available(spark, CollectionSpec("s", "s", "parquet"), lay)
    got = {r.a: (r._file_epoch_ms, r._source_file) for r in read_raw(spark, lay, "s").collect()}
    assert got[1][0] is None and "no%20epoch%20here.parquet" in got[1][1]
    assert got[2][0] == 1735689600000


def test_replay_of_a_batch_is_idempotent(spark, run_dir):
    lay = _layout(run_dir)
    _pq(lay.source_root, "r", "1735689600000_r_00_00.parquet", {"a": [1, 2, 3]})
    spec = CollectionSpec("r", "r", "parquet")
    files = spark.read.format("binaryFile").load(lay.glob(spec)).select("path", "length")
    h = BatchHandler(spec, lay)
    h(files, 0)
    h(files, 0)          # the same batch again, as after a crash before the commit
    assert read_raw(spark, lay, "r").count() == 3
    from loamflow.streaming.ingest import ingested_files

    man = ingested_files(spark, lay, "r").collect()
    assert len(man) == 1 and man[0].batch_id == 0
    raw_files = read_raw(spark, lay, "r").select(L.normalize_path("_source_file").alias("p")).distinct()
    assert [r.p for r in raw_files.collect()] == [
        r.p for r in ingested_files(spark, lay, "r").select(L.normalize_path("path").alias("p")).collect()]


def test_prefix_siblings_and_mixed_formats(spark, run_dir):
    lay = _layout(run_dir)
    assert not L.has_files(L.list_landing(spark, lay.source_root, DB))
    _pq(lay.source_root, "t", "1735689600000_t_00_00.parquet", {"a": [1]})
    _pq(lay.source_root, "t_x", "1735689600000_t_x_00_00.parquet", {"a": [2, 3]})
    _csv(lay.source_root, "t", "1735689600000_t_00_01.csv", "a\n9\n")
    files = L.list_landing(spark, lay.source_root, DB)
    assert L.has_files(files)
    assert {r.collection: r.format for r in L.detect_formats(files).collect()} == {"t": "parquet", "t_x": "parquet"}
    assert L.mixed_format_dirs(files).count() == 1
    ingest_available(spark, CollectionSpec("t", "t", "parquet"), lay)
    assert [r.a for r in read_raw(spark, lay, "t").collect()] == [1]   # sibling and CSV not read


def test_fallback_when_nothing_discovered(spark, run_dir):
    topics = O.topics_frame(spark, [("db.a", "high", 0), ("db.b", "low", 1)])
    res = resolve(spark, f"{run_dir}/empty", DB, topics)
    rows = {r.collection: (r.format, r.from_fallback) for r in res.collect()}
    assert rows == {"a": (None, True), "b": (None, True)}
    assert specs_from_resolved(res) == []


def test_continuous_trigger(spark, run_dir):
    lay = _layout(run_dir)
    _pq(lay.source_root, "k", "1735689600000_k_00_00.parquet", {"a": [1, 2]})
    spec = CollectionSpec("k", "k", "parquet", interval_seconds=1)
    q = start_ingest(spark, spec, lay, trigger="continuous")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_raw(spark, lay, "k").count() == 2


def test_measure_gz_and_steady_state(spark, run_dir):
    root = f"{run_dir}/landing"
    _csv(root, "g", "1735689600000_g_00_00.csv.gz", "a,b\n1,2\n3,4\n", gz=True)
    _csv(root, "g", "1735689600000_g_00_01.CSV", "a,b\n5,6\n")
    phases, batches = count_drains(spark, [("g", "csv", 100)], root, DB, f"{run_dir}/m", "r1", 1)
    assert [(r.phase, r.failure) for r in phases.collect()] == [("start", None), ("drain", None), ("stop", None)]
    assert batches.agg(F.sum("rows")).first()[0] == 2
    topics = O.topics_frame(spark, [("g", "low", 0)])
    res = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "BOUNDED_DRAIN", "pin")
    m = res["measurements"].first()
    # the listing sees upper-case and gz names, the glob only the lower-case forms
    assert (m.status, m.file_count, m.format, m.rows_seen) == ("OK", 2, "csv", 2)
    assert json.loads(m.batch_details_json)[0]["rows"] == 2
    _csv(root, "g", "1735689600001_g_00_02.csv", "a,b\n7,8\n9,10\n11,12\n")
    res2 = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "BOUNDED_DRAIN", "pin")
    assert res2["measurements"].first().rows_seen == 3
    proj = res2["projections"].collect()
    assert len(proj) == 5 and all(p.simple_ceil_collection_rounds == 1 for p in proj)
    s = res2["summary"].first()
    assert (s.parents_present, s.children_discovered, s.collections_measured, s.visible_files) == (1, 0, 1, 3)
    listed = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "LISTING_ONLY")
    lm = listed["measurements"].first()
    assert lm.status == "LISTED" and lm.rows_seen is None


def test_failure_and_isolation(spark, run_dir):
    import pytest

    lay = _layout(run_dir)
    d = _dir(lay.source_root, "bad")
    with open(f"{d}/1735689600000_bad_00_00.parquet", "wb") as f:
        f.write(b"this is not parquet")
    _pq(lay.source_root, "good", "1735689600000_good_00_00.parquet", {"a": [1, 2]})
    specs = [CollectionSpec("bad", "bad", "parquet"), CollectionSpec("good", "good", "parquet")]
    outcomes, _ = drain(spark, specs, lay, max_concurrent=2)
    got = {r.collection: (r.status, r.kind) for r in outcomes.collect()}
    assert got == {"good": ("ok", "ok"), "bad": ("failed", "genuine")}
    c = outcome_counts(outcomes).first()
    assert (c.ok, c.failed, list(c.failed_names)) == (1, 1, ["bad"])
    with pytest.raises(RuntimeError, match="1 collection.s. failed: bad"):
        report_and_raise(outcomes)
    assert read_raw(spark, lay, "good").count() == 2


def test_rate_limit_and_progress(spark, run_dir):
    lay = _layout(run_dir)
    for i in range(5):
        _pq(lay.source_root, "c", f"173568960000{i}_c_0{i}_00.parquet", {"a": [i]}, day=f"0{i + 1}")
    spec = CollectionSpec("c", "c", "parquet", max_files=2)
    outcomes, progress = drain(spark, [spec], lay)
    o = outcomes.first()
    assert (o.batches, o.files) == (3, 5)
    assert sorted((r.batch_id, r.input_files) for r in progress.collect()) == [(0, 2), (1, 2), (2, 1)]


def test_probe_falls_back_to_spark_footers(spark, run_dir, monkeypatch):
    from loamflow.streaming import ingest as I

    lay = _layout(run_dir)
    _pq(lay.source_root, "f", "1735689600000_f_00_00.parquet", {"a": [1]})
    _pq(lay.source_root, "f", "1735689600001_f_00_01.parquet", {"a": [2], "b": ["x"]})
    spec = CollectionSpec("f", "f", "parquet")
    files = spark.read.format("binaryFile").load(lay.glob(spec)).select("path", "length")
    direct = I.probe_groups(files, "parquet")
    monkeypatch.setattr(I, "_probe_partition", lambda fmt: (lambda it: (
        __import__("pandas").DataFrame({"path": pdf["path"], "signature": [None] * len(pdf)}) for pdf in it)))
    fallback = I.probe_groups(files, "parquet")
    groups = lambda got: sorted((tuple(p), I.parquet_schema(s).simpleString()) for s, p in got)
    assert groups(fallback) == groups(direct) and len(direct) == 2
    _csv(lay.source_root, "g", "1735689600000_g_00_00.csv.gz", "a,é\n1,2\n", gz=True)
    files = spark.read.format("binaryFile").load(f"{lay.source_root}/*/*/*/*/*/collection=g/*").select("path", "length")
    assert [s for s, _ in I.probe_groups(files, "csv")] == ["csv:a,é"]


def test_optional_columns_read_as_one_group(spark, run_dir):
    from loamflow.streaming import ingest as I

    lay = _layout(run_dir)
    for i in range(24):
        cols = {"id": [i]} | {f"c{j}": [i * 10 + j] for j in range(5) if i >> j & 1}
        _pq(lay.source_root, "o", f"17356896000{i:02d}_o_00_{i:02d}.parquet", cols)
    spec = CollectionSpec("o", "o", "parquet")
    files = spark.read.format("binaryFile").load(lay.glob(spec)).select("path", "length")
    groups = I.probe_groups(files, "parquet")
    assert len(groups) > 20 and len(I.merge_groups(groups)) == 1
    ingest_available(spark, spec, lay)
    rows = {r.id: r for r in read_raw(spark, lay, "o").collect()}
    assert all(rows[i][f"c{j}"] == (i * 10 + j if i >> j & 1 else None) for i in range(24) for j in range(5))
    assert all(r._rescued_data is None for r in rows.values())
    import glob as g

    assert len(g.glob(f"{lay.raw_path('o').removeprefix('file:')}/*/*.parquet")) <= 4


def test_own_column_names_and_backticks_are_kept(spark, run_dir):
    lay = _layout(run_dir)
    _pq(lay.source_root, "q", "1735689600000_q_00_00.parquet",
        {"a`b": [1], "_batch_id": [77], "_source_file": ["mine"], "_Ingested_At": ["x"], "__loamflow_batch": [5]})
    ingest_available(spark, CollectionSpec("q", "q", "parquet"), lay)
    r = read_raw(spark, lay, "q").first()
    assert (r["a`b"], r["_batch_id"]) == (1, 77) and r["_source_file"].endswith("_q_00_00.parquet")
    assert json.loads(r._rescued_data) == {"_source_file": "mine", "_Ingested_At": "x", "__loamflow_batch": 5}


def test_missing_raw_data_is_an_error(spark, run_dir):
    import pytest

    lay = _layout(run_dir)
    _pq(lay.source_root, "e", "1735689600000_e_00_00.parquet", {"a": [1]})
    spec = CollectionSpec("e", "e", "parquet")
    ingest_available(spark, spec, lay)
    wrong = Layout(lay.source_root, DB, f"{run_dir}/elsewhere", lay.checkpoint_root)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        row_counts(spark, wrong, [spec]).collect()


def test_old_files_are_not_skipped(spark, run_dir):
    lay = _layout(run_dir)
    spec = CollectionSpec("t", "t", "parquet")
    _pq(lay.source_root, "t", "1735689600000_t_00_00.parquet", {"a": [1]})
    ingest_available(spark, spec, lay)
    _pq(lay.source_root, "t", "1735689600001_t_00_01.parquet", {"a": [2]})
    os.utime(f"{_dir(lay.source_root, 't')}/1735689600001_t_00_01.parquet", (0, 0))
    ingest_available(spark, spec, lay)
    assert sorted(r.a for r in read_raw(spark, lay, "t").collect()) == [1, 2]


def test_paths_without_a_scheme(spark, run_dir):
    from loamflow.sources import storage

    plain = run_dir.removeprefix("file:")
    for root in (plain, f"file:{plain}", f"file://{plain}"):
        assert storage.qualify(spark, root) == f"file:{plain}"
        lay = _layout(f"{root}/s{len(root)}")
        _pq(lay.source_root.removeprefix("file:").replace("//", "/"), "s", "1735689600000_s_00_00.parquet", {"a": [1]})
        ingest_available(spark, CollectionSpec("s", "s", "parquet"), lay)
        assert read_raw(spark, lay, "s").count() == 1


def test_csv_malformed_lines_are_rescued(spark, run_dir):
    lay = _layout(run_dir)
    _csv(lay.source_root, "m", "1735689600000_m_00_00.csv", 'a,b\n1,2\n3,4,5\n6\n"7","x,y"\n')
    ingest_available(spark, CollectionSpec("m", "m", "csv"), lay)
    rows = sorted(((r.a, r.b, r._rescued_data) for r in read_raw(spark, lay, "m").collect()), key=str)
    assert rows == sorted([(1, "2", None), (3, "4", '{"_corrupt_record":"3,4,5"}'),
                           (6, None, '{"_corrupt_record":"6"}'), (7, "x,y", None)], key=str)


def test_listing_day_glob_prunes(spark, run_dir):
    root = f"{run_dir}/landing"
    for d in ("01", "02", "11"):
        _pq(root, "c", f"17356896000{d}_c_{d}_00.parquet", {"a": [1]}, day=d)
    assert L.list_landing(spark, root, DB).count() == 3
    assert L.list_landing(spark, root, DB, day="0[1-2]").count() == 2
    assert L.list_landing(spark, root, DB, day="2*").count() == 0


def _refuse(monkeypatch, marker, message):
    """Listing a folder whose path holds ``marker`` fails, in the tasks too."""
    def entries(fs, folder):
        if marker in folder:
            raise RuntimeError(message)
        import pyarrow.fs as pafs

        return [f for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name[0] not in "_."]
    monkeypatch.setattr(L, "_entries", entries)


def test_measure_listing_error_rows(spark, run_dir, monkeypatch):
    root = f"{run_dir}/landing"
    _pq(root, "a", "1735689600000_a_00_00.parquet", {"a": [1]})
    _refuse(monkeypatch, "day=", "throttled by the store")
    topics = O.topics_frame(spark, [("a", "high", 0)])
    res = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "BOUNDED_DRAIN")
    m = res["measurements"].first()
    assert (m.status, m.listing_status, m.file_count, m.rows_seen) == ("ERROR", "ERROR", None, None)
    assert "throttled" in m.error
    s = res["summary"].first()
    assert (s.errored_collections, s.visible_files) == (1, 0)
    import pytest

    with pytest.raises(OSError, match="throttled"):
        L.list_landing(spark, root, DB)


def test_one_unlistable_collection_is_the_only_error(spark, run_dir, monkeypatch):
    root = f"{run_dir}/landing"
    for c in ("a", "a_b"):
        _pq(root, c, f"1735689600000_{c}_00_00.parquet", {"a": [1]})
    _refuse(monkeypatch, "collection=a_b", "denied")
    topics = O.topics_frame(spark, [("a", "high", 0)])
    res = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "BOUNDED_DRAIN")
    got = {r.collection: (r.status, r.file_count, r.rows_seen, r.error) for r in res["measurements"].collect()}
    assert got == {"a": ("OK", 1, 1, None), "a_b": ("ERROR", None, None, "denied")}


def test_continuous_drain_starts_every_collection(spark, run_dir):
    import threading
    import time as _t

    lay = _layout(run_dir)
    for c in ("x", "y"):
        _pq(lay.source_root, c, f"1735689600000_{c}_00_00.parquet", {"a": [1]})
    specs = [CollectionSpec(c, c, "parquet", interval_seconds=1) for c in ("x", "y")]
    box = {}
    th = threading.Thread(target=lambda: box.setdefault(
        "r", drain(spark, specs, lay, max_concurrent=1, trigger="continuous")))
    th.start()
    from loamflow.streaming.ingest import query_name

    wanted = {query_name("raw", lay, c) for c in ("x", "y")}
    deadline = _t.time() + 120
    while _t.time() < deadline and len([q for q in spark.streams.active if q.name in wanted]) < 2:
        _t.sleep(0.5)
    qs = [q for q in spark.streams.active if q.name in wanted]
    assert len(qs) == 2            # both started although max_concurrent=1
    for q in qs:
        q.processAllAvailable()
        q.stop()
    th.join(timeout=120)
    outcomes, _ = box["r"]
    assert {r.collection: r.status for r in outcomes.collect()} == {"x": "ok", "y": "ok"}
    assert read_raw(spark, lay, "x").count() == 1 and read_raw(spark, lay, "y").count() == 1


def test_table_name_collision_is_refused(spark):
    import pytest

    from loamflow.plans.resolve import table_name_collisions

    resolved = spark.createDataFrame(
        [("ui-elements", "ui_elements", "parquet", "low", 100, 90),
         ("ui_elements", "ui_elements", "parquet", "low", 100, 90)],
        "collection string, name string, format string, tier string, max_files int, interval_seconds int")
    assert table_name_collisions(resolved).count() == 1
    with pytest.raises(ValueError, match="share a table name"):
        specs_from_resolved(resolved)


def test_drain_waves(spark, run_dir):
    from loamflow.streaming.drain import drain_waves

    lay = _layout(run_dir)
    _pq(lay.source_root, "w", "1735689600000_w_00_00.parquet", {"a": [1, 2]})
    spec = CollectionSpec("w", "w", "parquet")
    outcomes, _ = drain_waves(spark, [spec], lay, waves=2, pause_seconds=0.1)
    got = sorted((r.wave, r.status, r.files) for r in outcomes.collect())
    assert got == [(1, "ok", 1), (2, "ok", 0)]          # the second wave finds nothing new
    assert read_raw(spark, lay, "w").count() == 2


def test_gzip_csv_ingest_when_enabled(spark, run_dir):
    root = f"{run_dir}/landing"
    _csv(root, "z", "1735689600000_z_00_00.csv.gz", "a,b\n1,x\n2,y\n", gz=True)
    _csv(root, "z", "1735689600001_z_00_01.csv", "b,a\nq,3\n")
    plain = Layout(root, DB, f"{run_dir}/raw_plain", f"{run_dir}/ck_plain")
    ingest_available(spark, CollectionSpec("z", "z", "csv"), plain)
    assert read_raw(spark, plain, "z").count() == 1              # default glob: *.csv only
    gz = Layout(root, DB, f"{run_dir}/raw_gz", f"{run_dir}/ck_gz", gz=True)
    ingest_available(spark, CollectionSpec("z", "z", "csv"), gz)
    rows = sorted((r.a, r.b) for r in read_raw(spark, gz, "z").collect())
    assert rows == [(1, "x"), (2, "y"), (3, "q")]


def test_collection_name_with_glob_characters(spark, run_dir):
    lay = _layout(run_dir)
    name = "odd [x] name{1}"
    _pq(lay.source_root, name, "1735689600000_odd_00_00.parquet", {"a": [1, 2]})
    _pq(lay.source_root, "odd x name1", "1735689600000_other_00_00.parquet", {"a": [9]})
    files = L.list_landing(spark, lay.source_root, DB)
    assert sorted(r.collection for r in L.discover_collections(files).collect()) == sorted([name, "odd x name1"])
    ingest_available(spark, CollectionSpec(name, "odd", "parquet"), lay)
    assert sorted(r.a for r in read_raw(spark, lay, "odd").collect()) == [1, 2]


def test_nested_columns_evolve_through_the_stream(spark, run_dir):
    lay = _layout(run_dir)
    spec = CollectionSpec("n", "n", "parquet")
    _pq(lay.source_root, "n", "1735689600000_n_00_00.parquet",
        {"id": [1], "doc": pa.array([{"x": 1}], pa.struct([("x", pa.int64())]))})
    ingest_available(spark, spec, lay)
    _pq(lay.source_root, "n", "1735689700000_n_00_01.parquet",
        {"id": [2], "doc": pa.array([{"x": 2, "y": "new"}], pa.struct([("x", pa.int64()), ("y", pa.string())]))})
    ingest_available(spark, spec, lay)
    rows = sorted((r.id, r.doc.x, r.doc.y, r._rescued_data) for r in read_raw(spark, lay, "n").collect())
    assert rows == [(1, 1, None, None), (2, 2, "new", None)]


def test_measure_no_files_row(spark, run_dir):
    root = f"{run_dir}/landing"
    d = _dir(root, "j")
    with open(f"{d}/1735689600000_j_00_00.json", "w") as f:
        f.write('{"a": 1}\n')
    _pq(root, "j_child", "1735689600000_c_00_00.parquet", {"a": [1, 2]})
    topics = O.topics_frame(spark, [("j", "low", 0)])
    res = measure(spark, root, DB, f"{run_dir}/_measurement", topics, "BOUNDED_DRAIN")
    got = {r.collection: (r.status, r.format, r.file_count, r.micro_batches, r.rows_seen, r.drain_seconds,
                          r.batch_details_json) for r in res["measurements"].collect()}
    assert got["j"] == ("NO_FILES", None, 0, 0, 0, 0.0, "[]")
    assert got["j_child"][:5] == ("OK", "parquet", 1, 1, 2)
    size = os.path.getsize(f"{_dir(root, 'j_child')}/1735689600000_c_00_00.parquet")
    child = res["measurements"].where("collection = 'j_child'").first()
    assert (child.total_bytes, child.collection_dirs_checked) == (size, 1)
    assert res["summary"].first().visible_bytes == size
    with_clash = O.topics_frame(spark, [("u-x", "low", 0), ("u_x", "low", 1)])
    for c in ("u-x", "u_x"):
        _pq(root, c, "1735689600000_c_00_00.parquet", {"a": [1]})
    import pytest

    with pytest.raises(ValueError, match="share a measurement checkpoint"):
        measure(spark, root, DB, f"{run_dir}/_measurement", with_clash, "BOUNDED_DRAIN")
    proj = {r.max_workers: r.simple_ceil_collection_rounds for r in res["projections"].collect()}
    assert proj == {4: 1, 6: 1, 8: 1, 12: 1, 16: 1}       # only the OK collection counts


def test_plan_cuts_batches_by_age_and_cap(spark, run_dir):
    from loamflow.streaming.filestate import plan_files, planned_files

    lay = _layout(run_dir)
    specs = [CollectionSpec("p", "p", "parquet", max_files=2), CollectionSpec("p_x", "p_x", "csv", max_files=3)]
    names = [f"17356896000{i:02d}_p_00_00.parquet" for i in range(5)]
    for i, n in enumerate(names):
        _pq(lay.source_root, "p", n, {"a": [i]})
        os.utime(f"{_dir(lay.source_root, 'p')}/{n}", (1000 - i, 1000 - i))     # the last is the oldest
    _csv(lay.source_root, "p_x", "1735689600000_p_x_00_00.csv", "a\n1\n")
    _csv(lay.source_root, "p_x", "1735689600000_p_x_00_00.csv.gz", "a\n2\n", gz=True)   # not of this layout

    def plan():
        plan_files(spark, lay, specs)
        rows = planned_files(spark, lay).orderBy("name", "batch", "path").collect()
        return [(r.name, int(r.batch), r.path.rpartition("/")[2]) for r in rows]
    want = [("p", 0, names[3]), ("p", 0, names[4]), ("p", 1, names[1]), ("p", 1, names[2]), ("p", 2, names[0]),
            ("p_x", 0, "1735689600000_p_x_00_00.csv")]
    assert plan() == want and plan() == want            # nothing new, nothing planned
    _pq(lay.source_root, "p", "0000000000001_late.parquet", {"a": [9]})
    os.utime(f"{_dir(lay.source_root, 'p')}/0000000000001_late.parquet", (0, 0))
    assert plan() == sorted([*want, ("p", 3, "0000000000001_late.parquet")])
    h = ingest_available(spark, specs[0], lay)
    assert [p[1] for p in h.progress] == [2, 2, 1, 1] and sum(p[3] for p in h.progress) == 6


def test_readers_see_committed_batches_only(spark, run_dir):
    from loamflow.streaming.ingest import batch_folder

    lay = _layout(run_dir)
    spec = CollectionSpec("v", "v", "parquet")
    _pq(lay.source_root, "v", "1735689600000_v_00_00.parquet", {"a": [1, 2]})
    ingest_available(spark, spec, lay)
    before = read_raw(spark, lay, "v").collect()
    # a batch that was cut short: rows, but no manifest
    read_raw(spark, lay, "v").write.parquet(batch_folder(lay, "v", 1))
    assert read_raw(spark, lay, "v").collect() == before
    _pq(lay.source_root, "v", "1735689700000_v_00_01.parquet", {"a": [3]})
    ingest_available(spark, spec, lay)                  # batch 1 replaces what was left
    assert sorted(r.a for r in read_raw(spark, lay, "v").collect()) == [1, 2, 3]


def test_compaction_keeps_rows_and_later_batches(spark, run_dir):
    from loamflow.streaming.ingest import compact, raw_folders

    lay = _layout(run_dir)
    spec = CollectionSpec("w", "w", "parquet", max_files=1)
    for i in range(5):
        _pq(lay.source_root, "w", f"173568960000{i}_w_00_00.parquet", {"a": [i], **({"b": ["x"]} if i > 2 else {})})
    ingest_available(spark, spec, lay)
    rows = sorted(map(str, read_raw(spark, lay, "w").collect()))
    assert len(raw_folders(spark, lay, "w")) == 5 and compact(spark, lay, "w", target_bytes=1) == 0
    assert compact(spark, lay, "w") == 5 and len(raw_folders(spark, lay, "w")) == 1
    assert sorted(map(str, read_raw(spark, lay, "w").collect())) == rows and compact(spark, lay, "w") == 0
    _pq(lay.source_root, "w", "1735689700000_w_00_00.parquet", {"a": [7]})
    ingest_available(spark, spec, lay)
    assert read_raw(spark, lay, "w").count() == 6 and len(raw_folders(spark, lay, "w")) == 2


def test_batch_writes_without_a_shuffle(spark, run_dir, monkeypatch):
    from loamflow.streaming import ingest as In

    lay, plans, real = _layout(run_dir), [], In.finish

    def finish(df, tracked):
        out = real(df, tracked)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(In, "finish", finish)
    _pq(lay.source_root, "z2", "1735689600000_z_00_00.parquet", {"a": [1]})
    ingest_available(spark, CollectionSpec("z2", "z2", "parquet"), lay)
    assert plans and "Exchange" not in plans[0]


def test_planner_stream_feeds_continuous_drains(spark, run_dir):
    import time as _t

    from loamflow.streaming.filestate import start_planner

    lay = _layout(run_dir)
    spec = CollectionSpec("pc", "pc", "parquet", interval_seconds=1)
    q = start_ingest(spark, spec, lay, trigger="continuous")
    planner = start_planner(spark, lay, [spec], 1)
    try:
        _pq(lay.source_root, "pc", "1735689600000_pc_00_00.parquet", {"a": [5]})
        end = _t.time() + 60
        while (raw := read_raw(spark, lay, "pc")) is None and _t.time() < end:
            _t.sleep(0.5)
    finally:
        planner.stop()
        q.stop()
    assert [r.a for r in raw.collect()] == [5]


def test_count_drain_of_many_small_batches(spark, run_dir):
    """A batch of small files is one job with one reading task, whatever the cores, and the caller's
    settings stay as they are."""
    from loamflow.streaming.measure import count_stream, drain_session, drain_settings

    root, adaptive = f"{run_dir}/landing", spark.conf.get("spark.sql.adaptive.enabled")
    for i in range(24):
        _pq(root, "s", f"17356896000{i:02d}_s_{i:02d}_00.parquet", {"a": [i, i]}, day=f"{i % 4 + 1:02d}")
    done = []
    session = drain_session(spark, drain_settings(spark, run_dir), 2, 24, 24 * 400)
    query = count_stream(session, root, DB, "s", "parquet", 2, f"{run_dir}/m/s", "many_small", lambda *b: done.append(b))
    query.awaitTermination()
    assert [b[:2] for b in done] == [(i, 4) for i in range(12)]
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    assert len(jobs) == 12
    assert sum(tracker.getStageInfo(i).numTasks for j in jobs for i in j.stageIds) == 24  # one reads, one adds up
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_count_drain_takes_the_listed_files(spark, run_dir):
    """Files directly in a collection's folders only, as the listing has them: neither what lies in a
    folder with a file's name, nor in one that looks like a partition."""
    for coll, sub in (("plain", "old.parquet"), ("parted", "hour=01")):
        root = f"{run_dir}/{coll}"
        _pq(root, coll, "1735689600000_x_00_00.parquet", {"a": [1, 2]})
        _pq(root, f"{coll}2", "1735689600000_x_00_00.parquet", {"a": [1, 2, 3]})
        os.makedirs(f"{_dir(root, coll)}/{sub}")
        pq.write_table(pa.table({"a": [3, 4, 5]}), f"{_dir(root, coll)}/{sub}/1735689600001_x_00_01.parquet")
        topics = O.topics_frame(spark, [(coll, "low", 0)])
        m = measure(spark, root, DB, f"{root}/_measurement", topics, "BOUNDED_DRAIN")["measurements"].first()
        assert (m.status, m.file_count, m.rows_seen, m.micro_batches) == ("OK", 1, 2, 1)


def test_count_drain_looks_up_a_batch_in_few_tasks(spark, run_dir):
    """The files of a large batch are looked up by as many tasks as there are cores, so that the driver
    gets a result a core, not one a file."""
    from loamflow.streaming.measure import count_stream, drain_session, drain_settings

    root = f"{run_dir}/landing"
    for i in range(24):
        _pq(root, "l", f"17356896000{i:02d}_l_{i:02d}_00.parquet", {"a": [i, i]})
    done = []
    settings = drain_settings(spark, run_dir) | {"spark.sql.sources.parallelPartitionDiscovery.threshold": "3"}
    query = count_stream(drain_session(spark, settings, 100, 24, 24 * 400), root, DB, "l", "parquet", 100,
                         f"{run_dir}/m/l", "few_tasks", lambda *b: done.append(b))
    query.awaitTermination()
    assert [b[:2] for b in done] == [(0, 48)]
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(query.runId))]
    cores = spark.sparkContext.defaultParallelism
    assert len(jobs) > 1 and max(tracker.getStageInfo(i).numTasks for j in jobs for i in j.stageIds) <= cores


def test_count_drain_of_small_files_is_a_task_a_batch(spark, run_dir, monkeypatch):
    """A batch that can't be large is counted by the task that reads it, and its checkpoint has no
    checksum files, each of which takes a process; every batch is counted and checkpointed."""
    from loamflow.streaming import measure as M

    root, started, start = f"{run_dir}/landing", [], M.count_stream
    for i in range(24):
        _pq(root, "t", f"17356896000{i:02d}_t_{i:02d}_00.parquet", {"a": [i, i]}, day=f"{i % 4 + 1:02d}")
    monkeypatch.setattr(M, "count_stream", lambda *a, **k: started.append(start(*a, **k)) or started[-1])
    res = M.measure(spark, root, DB, f"{run_dir}/m", O.topics_frame(spark, [("t", "low", 0)]), "BOUNDED_DRAIN", "small",
                    tiers=O.tiers_frame(spark, [("low", 2, 90)]))
    assert [(r.batch_id, r.rows) for r in res["batches"].orderBy("batch_id").collect()] == [(i, 4) for i in range(12)]
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(str(started[0].runId))]
    assert [tracker.getStageInfo(i).numTasks for j in jobs for i in j.stageIds] == [1] * 12
    names = [f for _, _, files in os.walk(f"{run_dir}/m/small/checkpoints") for f in files]
    assert "11" in names and not [f for f in names if f.endswith(".crc")]


def test_only_small_batches_are_one_task():
    from loamflow.streaming.measure import fits_one_task

    assert fits_one_task(7, 100_000) and fits_one_task(7, 3 << 20)
    assert not fits_one_task(7, 4 << 20) and not fits_one_task(3000, 1) and not fits_one_task(7)
