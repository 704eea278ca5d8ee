"""A third and more of the rows under one key: same results, work still spread."""

import datetime as dt

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparktide.operators import activity, blocking, joins, mutations, ordering, predicates, slices
from sparktide.streaming import sinks

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """Session 1 holds two thirds of the rows; session null exists too."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 1)
        .when(F.col("id") % 7 == 0, None)
        .otherwise((F.col("id") % 5).cast("int"))
        .alias("session_id"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 37 % 3001).cast("int")))
        .alias("collection_time"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 101).alias("v"),
        F.col("id"),
    )
    return rows.cache()


@pytest.mark.parametrize("ahead", [False, True])
def test_sliced_neighbour_equals_window(hot, assert_same, ahead):
    order = Window.partitionBy("session_id").orderBy("collection_time", "id")
    step = F.lead if ahead else F.lag
    plain = hot.withColumn("near", step("v").over(order))
    sliced = slices.neighbour(
        hot, ["session_id"], ["collection_time", "id"], {"near": "v"}, F.to_date("collection_time"), ahead
    )
    assert_same(plain, sliced)


def test_delta_of_hot_session(hot, assert_same):
    order = Window.partitionBy("session_id").orderBy("collection_time")
    unique = hot.dropDuplicates(["session_id", "collection_time"]).cache()
    plain = unique.withColumn("v_delta", F.col("v") - F.lag("v").over(order))
    assert_same(plain, activity.activity_delta(unique, ["v"]))


@pytest.mark.parametrize("n", [3, 1200])
def test_latest_of_hot_key(hot, assert_same, n):
    order = [F.desc("collection_time"), F.desc("id")]
    ranked = hot.withColumn("r", F.row_number().over(Window.partitionBy("session_id").orderBy(*order)))
    assert_same(ranked.where(F.col("r") <= n).drop("r"), sinks.recent_events(hot, n, order, "session_id"))


def test_latest_without_a_key(hot):
    order = [F.desc("collection_time"), F.desc("id")]
    rows = [r.id for r in sinks.recent_events(hot, 5, order).collect()]
    assert rows == [r.id for r in hot.orderBy(*order).take(5)]


def test_latest_is_cut_before_the_shuffle(hot):
    df = sinks.recent_events(hot, 3, [F.desc("collection_time"), F.desc("id")], "session_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_numbers_over_equal_rows_are_spread(spark):
    same = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ordering.number_rows(same, ["k"])
        ids = numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id")).head()
        files = len(set(numbered.inputFiles()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(ids) == (1, 40_000, 40_000)
    assert files > 1


def test_identity_follows_the_order(hot, assert_same):
    numbered = mutations.assign_identity(hot, ["collection_time", "id"], "n", start=10, step=5)
    place = F.row_number().over(Window.orderBy("collection_time", "id"))
    assert_same(hot.withColumn("n", (F.lit(5) + place * 5).cast("bigint")), numbered)


def test_semi_join_reduces_hot_child_first(spark, assert_same):
    parent = spark.range(100).withColumnRenamed("id", "p")
    child = spark.range(30_000).select(F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 50).alias("c"))
    semi = joins.semi_join_in(parent, child, "p", "c")
    assert_same(semi, parent.join(child, F.col("p") == F.col("c"), "left_semi"))
    assert semi.count() == 50


@pytest.fixture()
def no_broadcast(spark):
    """Joins by shuffle, with limits at which a few kilobytes are a hot partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_waiters_are_split_by_aqe(spark, no_broadcast, work):
    """The lookup of the chain rounds: both sides come from written tables."""
    spark.range(0, 200_000, 1, 16).select(
        F.col("id").alias("node"), F.when(F.col("id") % 3 < 2, 1).otherwise(F.shiftright("id", 1)).alias("at")
    ).write.parquet(work)
    state = spark.read.parquet(work)
    above = state.select(F.col("node").alias("_node"), F.col("at").alias("_at"))
    joined = state.join(above, F.col("at") == F.col("_node"), "left")
    assert len(joined.collect()) == 200_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", ["baseline", "in table"])
def test_hot_key_against_an_aggregate_is_split(spark, no_broadcast, operator):
    """Two thirds of the rows under one key and many nulls: the aggregate is written, AQE splits the rest."""
    runs = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 3 < 2, 1).when(F.col("id") % 7 > 0, F.col("id") % 1000).alias("q"),
        F.xxhash64("id").alias("t"),
    )
    if operator == "baseline":
        small = runs.select("q", (F.col("t") % 97).alias("t"))
        df, rows = activity.average_time_baseline(small, runs, "q", "t"), 200_000
    else:
        df = predicates.filter_in_table(runs, "q", runs.select("q"))
        rows = runs.where("q IS NOT NULL").count()
    assert len(df.collect()) == rows
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


# --- chains and cycles --------------------------------------------------------------


def _snapshot(spark, pairs):
    rows = [(START, s, b, f"login_{s}", "LCK_M_X") for s, b in pairs]
    return spark.createDataFrame(
        rows,
        "collection_time timestamp_ntz, session_id bigint, blocking_session_id bigint, login_name string,"
        " wait_info string",
    )


def test_chain_of_depth_four_and_a_crowd(spark):
    chain = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4)]
    crowd = [(100 + i, 50) for i in range(2000)] + [(50, None)]
    leaders = blocking.block_leaders(_snapshot(spark, chain + crowd)).collect()
    assert [(r.session_id, r.blocked_session_count, r.blocked_direct) for r in leaders] == [
        (50, 2000, 2000), (1, 4, 1),
    ]


def test_leader_outside_the_snapshot_is_reported(spark):
    leaders = blocking.block_leaders(_snapshot(spark, [(2, 1), (3, 2)])).collect()
    assert [(r.session_id, r.blocked_session_count, r.login_name) for r in leaders] == [(1, 2, None)]


def test_cycles_have_no_leader(spark):
    pairs = [(1, 2), (2, 1), (3, 1), (4, None), (5, 4)]
    assert [r.session_id for r in blocking.block_leaders(_snapshot(spark, pairs)).collect()] == [4]


def test_nothing_blocked(spark):
    assert blocking.block_leaders(_snapshot(spark, [(1, None)])).count() == 0


def _reached(pairs):
    """node -> all nodes that its waits lead to."""
    out = {}
    for w, h in pairs:
        out.setdefault(w, set()).add(h)
    found = {}
    for w in out:
        todo, seen = list(out[w]), set()
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += out.get(n, ())
        found[w] = seen
    return found


def _random_waits(seed, n, waits, back):
    """Waits mostly for smaller sessions, some for larger ones, some twice."""
    rng = random.Random(seed)
    pairs = [(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(waits)) if a > b or rng.random() < back]
    return pairs + pairs[: n // 4]


@pytest.mark.parametrize("seed,back", [(1, 0.0), (2, 0.1)])
def test_leaders_of_sessions_with_several_holders(spark, seed, back):
    """Several requests and several holders: equal to walking every path."""
    pairs = _random_waits(seed, 60, 80, back)
    reached = _reached(pairs)
    expected = {}
    for w, nodes in reached.items():
        for head in nodes - set(reached):
            all_, direct = expected.get(head, (0, 0))
            expected[head] = (all_ + 1, direct + ((w, head) in pairs))
    rows = _snapshot(spark, pairs + [(n, None) for n in range(30)])
    found = {r.session_id: (r.blocked_session_count, r.blocked_direct) for r in blocking.block_leaders(rows).collect()}
    assert found == expected


@pytest.mark.parametrize("seed,n,waits,back", [(1, 40, 60, 1.0), (2, 80, 100, 0.15), (3, 60, 40, 1.0)])
def test_deadlocks_are_the_components_of_all_paths(spark, seed, n, waits, back):
    pairs = _random_waits(seed, n, waits, back) + [(1_000 + i, 1_000 + (i + 1) % 30) for i in range(30)]
    # A long ring with one short cut: one session has two holders, the others one.
    pairs += [(2_000 + i, 2_000 + (i + 1) % 50) for i in range(50)] + [(2_007, 2_031), (2_003, 1), (5, 2_040)]
    reached = _reached(pairs)
    groups = {a: min(b for b in nodes if a in reached.get(b, ())) for a, nodes in reached.items() if a in nodes}
    expected = {}
    for a, b in pairs:
        if a in groups and groups.get(b) == groups[a]:
            expected.setdefault(groups[a], set()).add((a, b))
    edges = spark.createDataFrame(pairs, "waiter bigint, holder bigint")
    found, sizes = {}, {}
    for r in blocking.deadlock_cycles(edges).collect():
        assert (r.waiter, r.holder) not in found.setdefault(r.deadlock_id, set())
        found[r.deadlock_id].add((r.waiter, r.holder))
        sizes[r.deadlock_id] = r.participants
    assert found == expected
    assert sizes == {g: sum(x == g for x in groups.values()) for g in expected}


def _cycles(spark, pairs):
    edges = spark.createDataFrame(pairs, "waiter bigint, holder bigint")
    found = {}
    for r in blocking.deadlock_cycles(edges).collect():
        found.setdefault(r.deadlock_id, set()).add((r.waiter, r.holder))
        assert r.participants >= 1
    return found


def test_cycles_of_several_lengths(spark):
    two = [(1, 2), (2, 1)]
    three = [(10, 11), (11, 12), (12, 10)]
    long = [(100 + i, 100 + (i + 1) % 9) for i in range(9)]
    itself = [(500, 500)]
    tails = [(20, 10), (21, 20), (22, 21), (30, 31), (31, None)] + [(1000 + i, 2) for i in range(500)]
    assert _cycles(spark, two + three + long + itself + tails) == {
        1: set(two), 10: set(three), 100: set(long), 500: set(itself),
    }


def test_no_cycle(spark):
    assert _cycles(spark, [(1, 2), (2, 3), (3, None)]) == {}
    assert _cycles(spark, [(1, None)]) == {}


def test_rounds_of_the_deadlock_search_broadcast_nothing(spark, monkeypatch):
    """A line of 10 components: few colourings, and no join of them passes the driver."""
    pairs = [(3 * i + a, 3 * i + b) for i in range(10) for a, b in ((0, 1), (1, 0), (1, 2), (2, 1))] + [(3 * i + 2, 3 * i + 3) for i in range(9)]
    plans, rounds, write = [], [], blocking.materialise

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        rounds.append(label)
        return write(df, label)

    monkeypatch.setattr(blocking, "materialise", seen)
    found = _cycles(spark, pairs)
    assert found == {3 * i: {(3 * i + a, 3 * i + b) for a, b in ((0, 1), (1, 0), (1, 2), (2, 1))} for i in range(10)}
    assert not any("Broadcast" in plan for plan in plans)
    assert rounds.count("components") < 8
