import duckdb
import pytest

import __spark_entry__ as E
from loamflow.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    mine = set(Q.QUERIES)
    assert mine <= set(q) and mine - set(o) == {"batch_details_json", "drain_projection"}
    assert "batch_rows_json" in o


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = {r.collection: r.n for r in df.collect()}
    ev = duckdb.sql(f"SELECT 'events_' || event_type, count(*) FROM '{SF}/events.parquet' GROUP BY 1").fetchall()
    assert rows == dict(ev)
    assert df.columns == ["collection", "n"]


@pytest.mark.parametrize("name", ["file_epoch", "longest_prefix_owner", "shard_membership",
                                  "topic_dedupe", "name_normalise", "makespan", "restart_verdict",
                                  "failure_kind", "listing_stats", "evolved_columns",
                                  "batch_rows_json", "raw_content", "listing_tree",
                                  "measured_fallback", "rescued_type_pairs"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "customer", "nation", "documents", "pages", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(r[i] for i in idx) for r in res.fetchall()), key=repr)
    assert got == exp
