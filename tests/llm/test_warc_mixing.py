import base64
import gzip
import hashlib

import duckdb
from loamflow.llm import mixing, warc
from loamflow.session import new_run_dir

PAGES = "page_id long, url string, html string, record_type string, body string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_of_odd_payloads(spark):
    html = ["a", None, "", "WARC/1.1\r\n\r\nx\r\n\r\n", "é" * 50_000, "a", "a", None, "end\r\n\r\n"]
    rows = [(i, f"http://x/{i}\r\nEvil: 1", h) for i, h in enumerate(html)]
    got = {r.page_id: r for r in warc.warc_round_trip(spark, pages(spark, rows)).collect()}
    first = {}
    for i, _, h in rows:
        r, lead = got[i], first.setdefault(h or "", i)
        assert (r.payload_bytes, r.payload_digest) == (len((h or "").encode()), digest(h))
        assert (r.record_type, r.refers_to) == (("response", None) if lead == i else ("revisit", lead))
        assert r.uri == f"http://x/{i}  Evil: 1"
    assert len(got) == len(rows)


def test_small_payloads_and_repeated_rows(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, None, "abcdef"), (4, "u", "abcdef"), (4, "u", "abcdef"),
            (None, "u", "abcdef"), (4, "u", "other")]
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0)
                 for r in warc.warc_round_trip(spark, pages(spark, rows), min_bytes=3).collect())
    assert got == [(0, 6, "response", 0), (1, 2, "response", 0), (2, 2, "response", 0), (3, 6, "response", 0),
                   (4, 5, "response", 0), (4, 6, "revisit", 3), (4, 6, "revisit", 3)]


def test_empty_pages(spark):
    assert warc.warc_round_trip(spark, pages(spark, [])).collect() == []


def test_existing_revisits_are_followed(spark):
    raw, clean = new_run_dir(spark, "t"), new_run_dir(spark, "t")
    warc.write_archive(warc.page_records(pages(spark, [(5, "u", "body")])).union(
        warc.page_records(pages(spark, [(9, "u", "body")])).selectExpr(
            "page_id", "uri", "'revisit'", "5L", "payload_digest", "body")), raw)
    warc.deduplicate(spark, raw, clean)
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.resolved(spark, clean).collect()}
    assert got == {5: ("response", None, 4), 9: ("revisit", 5, 4)}


def test_parser_reads_members_and_plain_and_refuses_cut_files():
    rec = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    for data in (rec * 2, gzip.compress(rec) * 2, gzip.compress(rec * 2)):
        assert [b for _, b in warc.parse_records(data)] == [b"abc", b"abc"]
    assert list(warc.parse_records(b"")) == []
    for bad in (rec[:-6], rec + b"WARC/1.1\r\nX"):
        try:
            list(warc.parse_records(bad))
        except ValueError:
            continue
        raise AssertionError(bad)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, key string"


def test_mix_matches_sql_with_nulls_ties_and_caps(spark):
    rows = [(i % 40, None if i % 17 == 0 else "w " * (i * 7 % 90), "en", [None, "a", "b", "c", "é", ""][i % 6]
             if i % 3 else "big", 0, "x", "y") for i in range(400)]
    rows += [(None, "one two", "en", None, 0, "x", "y"), (7, "", "en", "tiny", 0, "x", "y")]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    want = con.execute(mixing.ORACLE_MIX).fetchall()
    cols = ("doc_id", "size", "source_size", "target", "taken")
    norm = lambda rs: sorted(((-1 if r[0] is None else int(r[0])), r[1], r[2], round(r[3], 6), r[4]) for r in rs)
    mine = [tuple(r) for r in got.select(*cols).collect()]
    assert norm(mine) == norm(want)
    by = {r.source: r for r in got.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    for r in by.values():
        assert r["sum(taken)"] == int(r["max(target)"])
    assert all(r[4] <= 3 * r[1] for r in mine)


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    rows = mixing.mix(spark.createDataFrame([(1, None, "", "s", 0, "", "")], DOCS)).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)]
