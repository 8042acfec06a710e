"""Plan-shape checks: the properties that matter at scale, asserted on executed plans."""

from loamflow.operators import ownership as O
from loamflow.operators.restarts import restart_verdict
from loamflow.plans import queries as Q
from loamflow.sources import landing as L

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_listing_reads_no_content(spark, run_dir):
    run = Q.LandedRun(spark, "plan")
    run.land(Q.landing_frame(Q._table(spark, SF, "events")))
    files = L.list_landing(spark, run.root, Q.DATABASE)
    text = files._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # what tasks found is read from the snapshot; the landing zone itself is in no file index
    assert "Scan parquet" in text and "binaryFile" not in text and run.root not in text
    assert {"path:string", "length:bigint"} <= set(text.split("ReadSchema: struct<")[1].split(">")[0].split(","))
    assert "content" not in text


def test_ownership_is_an_equi_join(spark):
    names, parents = Q._part_names(spark, SF)
    plan = _plan(O.owners(names, parents, "name"))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_restart_verdict_has_no_single_partition_window(spark):
    plan = _plan(restart_verdict(Q._attempts(spark, SF), width=64))
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "Join" not in final


def test_makespan_and_rounds_need_no_join(spark):
    for name in ("makespan", "ceil_rounds"):
        plan = _plan(Q.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_resolve_lists_once(spark, run_dir):
    from loamflow.plans.resolve import resolve

    run = Q.LandedRun(spark, "plan")
    run.land(Q.landing_frame(Q._table(spark, SF, "events")))
    plan = _plan(resolve(spark, run.root, Q.DATABASE, Q._topics(spark)))
    assert "binaryFile" not in plan and "CartesianProduct" not in plan


def test_shards_rank_without_a_window_over_all_owners(spark, run_dir):
    owned = Q._table(spark, SF, "customer").selectExpr("concat('o', c_custkey) AS owner")
    plan = _plan(O.shard_assignment(owned, 3)).split("== Initial Plan ==")[0]
    assert "windowspecdefinition(owner#" not in plan and "windowspecdefinition(owner_rank_part#" in plan
    alone = _plan(O.shard_assignment(owned, 1))
    assert "Window" not in alone and "Exchange" not in alone


def test_topics_reach_the_ordered_aggregate_once_per_distinct_topic(spark):
    plan = _plan(O.dedupe_topics(Q._doc_topics(spark, SF))).split("== Initial Plan ==")[0]
    assert "HashAggregate(keys=[collection" in plan.rsplit("SortAggregate", 1)[-1]
