import pytest

from loamflow.operators import ownership as O


def _owner_map(spark, names, parents):
    n = spark.createDataFrame([(x,) for x in names], "name string")
    p = spark.createDataFrame(parents, "parent string, tier string")
    return {r.name: (r.owner, r.tier) for r in O.owners(n, p, "name").collect()}


def _brute(name, parents):
    best = None
    for p, t in parents:
        if name == p or name.startswith(p + "_"):
            if best is None or len(p) > len(best[0]):
                best = (p, t)
    return best or (None, None)


def test_owner_cases(spark):
    parents = [("a", "high"), ("a_b", "low"), ("transactions", "high"), ("ui-elements", "low"),
               ("x_", "medium")]
    names = ["a", "a_b", "a_b_c", "a_bc", "ab", "transactions_statuslogs", "transactionsx",
             "ui-elements", "ui-elements_v2", "ui_elements", "x__y", "x_", "zzz", "a__b", "_a"]
    got = _owner_map(spark, names, parents)
    for n in names:
        assert got[n] == _brute(n, parents), n


def test_tier_restriction_changes_owner(spark):
    topics = O.topics_frame(spark, [("db.a", "high", 0), ("db.a_b", "low", 1)])
    parents = O.parents_frame(topics, priority="high")
    n = spark.createDataFrame([("a_b_c",)], "name string")
    r = O.owners(n, parents, "name").first()
    assert (r.owner, r.tier) == ("a", "high")


def test_dedupe_and_conflicts(spark):
    topics = O.topics_frame(spark, [("db.a", "high", 0), ("a", "high", 1), ("db.b", "low", 2)],
                            extra_rows=[("db.c", "medium", 0), ("db.b", "low", 1)])
    d = {r.collection: (r.topic, r.tier) for r in O.dedupe_topics(topics).collect()}
    assert d == {"a": ("db.a", "high"), "b": ("db.b", "low"), "c": ("db.c", "medium")}
    O.assert_no_tier_conflicts(topics)
    bad = O.topics_frame(spark, [("db.a", "high", 0), ("db.a", "low", 1)])
    with pytest.raises(ValueError, match="several tiers"):
        O.assert_no_tier_conflicts(bad)
    # measurement canonical form: trimmed bare name, no prefix folding
    t2 = O.topics_frame(spark, [(" ui-elements ", "low", 0), ("ui_elements", "low", 1)])
    assert O.dedupe_topics(t2, canonical="trim").count() == 2


def test_default_topics(spark):
    t = O.topics_frame(spark)
    assert t.count() == 51
    assert O.tier_conflicts(t).count() == 0
    by_tier = {r.tier: r["count"] for r in O.parents_frame(t).groupBy("tier").count().collect()}
    assert by_tier == {"high": 14, "medium": 9, "low": 28}


def test_select_and_fallback(spark):
    parents = spark.createDataFrame([("a", "high"), ("b", "low")], "parent string, tier string")
    disc = spark.createDataFrame([("a",), ("a_x",), ("c",)], "collection string")
    sel, fb = O.select_collections(disc, parents)
    assert not fb
    assert {(r.collection, r.owner, r.is_parent) for r in sel.collect()} == {("a", "a", True), ("a_x", "a", False)}
    empty = spark.createDataFrame([], "collection string")
    sel2, fb2 = O.select_collections(empty, parents)
    assert fb2 and sorted(r.collection for r in sel2.collect()) == ["a", "b"]


def test_shards_round_robin(spark):
    sel = spark.createDataFrame([("b_1", "b"), ("a", "a"), ("c", "c"), ("a_2", "a"), ("d", "d")],
                                "collection string, owner string")
    got = {r.collection: r.shard_index for r in O.shard_assignment(sel, 3).collect()}
    # owners sorted a, b, c, d -> 0, 1, 2, 0; children follow their owner
    assert got == {"a": 0, "a_2": 0, "b_1": 1, "c": 2, "d": 0}


def test_owner_matches_brute_force_on_random_names(spark):
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab_") for _ in range(n))
    parents = sorted({word(rng.randint(1, 4)) for _ in range(40)})
    tiers = [(p, rng.choice(["high", "medium", "low"])) for p in parents]
    names = sorted({word(rng.randint(1, 9)) for _ in range(500)})
    got = _owner_map(spark, names, tiers)
    for n in names:
        assert got[n] == _brute(n, tiers), n
