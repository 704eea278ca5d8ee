"""Edges of the operators: thresholds, nulls, ends of ranges, empty inputs."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparktide.functions import conversion, temporal
from sparktide.operators import antipatterns, audit, history, mutations, ordering, predicates
from sparktide.operators import activity as activity_ops
from sparktide.sources import snapshots, tables as source_tables
from sparktide.workspace import materialise


def _stamps(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return df.select("id", F.col("t").cast("timestamp_ntz").alias("t"))


def test_last_day_of_year(spark):
    rows = _stamps(spark, "2012-01-01 00:00:00", "2012-12-31 00:00:00", "2012-12-31 23:59:59", "2013-01-01 00:00:00")
    assert predicates.count_year_between(rows, "t", 2012, "id").head()[0] == 2
    assert predicates.count_year_half_open(rows, "t", 2012, "id").head()[0] == 3
    assert predicates.count_year_function(rows, "t", 2012, "id").head()[0] == 3


def test_day_covers_all_its_times(spark):
    rows = _stamps(spark, "2016-01-01 00:00:00", "2016-01-01 12:00:00", "2016-01-02 00:00:00")
    assert predicates.count_day_as_text(rows, "t", dt.date(2016, 1, 1), "id").head()[0] == 2


@pytest.mark.parametrize(
    "as_of,years,hits",
    [
        (dt.datetime(2023, 2, 28), 1, {"2024-02-28", "2024-02-29"}),
        (dt.datetime(2022, 2, 28), 1, {"2023-02-28"}),
        (dt.datetime(2024, 2, 29), 1, set()),
        (dt.datetime(2024, 2, 28), 1, {"2025-02-28"}),
        (dt.datetime(2020, 2, 29), 4, {"2024-02-29"}),
        (dt.datetime(2020, 2, 28), 4, {"2024-02-28"}),
    ],
)
def test_shifted_date_on_leap_days(spark, as_of, years, hits):
    days = ["2023-02-28", "2024-02-28", "2024-02-29", "2025-02-28", "2025-03-01"]
    rows = _stamps(spark, *days)
    literal = rows.where(
        F.col("t") - F.make_interval(years=F.lit(years)) == F.lit(as_of).cast("timestamp_ntz")
    )
    assert {str(r.t.date()) for r in literal.collect()} == hits
    assert predicates.count_shifted_date_equals(rows, "t", as_of, "id", years).head()[0] == len(hits)


def test_sentinel_also_matches_a_real_value(spark):
    rows = _stamps(spark, None, "1901-01-01 00:00:00", "2012-01-01 00:00:00")
    sentinel = dt.datetime(1901, 1, 1)
    assert predicates.filter_null_sentinel(rows, "t", None, sentinel).count() == 2
    assert predicates.filter_null_safe(rows, "t", None).count() == 1
    assert predicates.filter_null_or(rows, "t", None).count() == 1


def test_numbers_against_text_that_is_no_number(spark):
    rows = spark.createDataFrame([("1",), ("01",), ("x",), (None,)], "v string")
    assert predicates.filter_in_text_vs_numbers(rows, "v", [1]).count() == 1
    assert predicates.filter_in_text_vs_numbers(rows, "v", [1], numeric=True).count() == 2
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        rows.where("v = 1").collect()


def test_division_by_zero_raises(spark):
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        spark.range(1).select(F.lit(1) / F.lit(0)).collect()
    with pytest.raises(PySparkException, match="DIVIDE_BY_ZERO"):
        spark.range(1).select(conversion.whole_division(F.lit(1), F.lit(0))).collect()
    assert spark.range(1).select(conversion.divide_or_null(F.lit(1), F.lit(0))).head()[0] is None


def test_suffix_that_cannot_match(spark):
    rows = spark.createDataFrame([("a",), (None,)], "c string")
    assert predicates.filter_suffixed_equals(rows, "c", "?", "a!").count() == 0
    assert predicates.filter_suffixed_equals(rows, "c", "?", "a?").count() == 1


def test_not_in_drops_nulls(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert [r.c for r in predicates.filter_not_in(rows, "c", ["a"]).collect()] == ["b"]


def test_case_without_match_equals_nothing(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "n int, c string")
    kept = predicates.filter_case_equals(rows, "n", [(F.col("c") == "x", 1)])
    assert [r.n for r in kept.collect()] == [1]


def test_collation_is_optional(spark):
    rows = spark.createDataFrame([("Global_1",), ("global_2",), ("other",)], "login_name string")
    assert predicates.filter_like(rows, "login", "Global%").count() == 1
    assert predicates.filter_like(rows, "login", "GLOBAL%", "UTF8_LCASE").count() == 2
    assert predicates.filter_like_contains(rows, "login_name", "OBAL", "UTF8_LCASE").count() == 2


def test_column_patterns():
    columns = ["dd_hh_mm", "session_id", "cpu", "cpu_delta", "percent_complete"]
    assert predicates.columns_like(columns, "[session_id][%delta][%]") == [
        "session_id", "cpu_delta", "dd_hh_mm", "cpu", "percent_complete",
    ]
    assert predicates.columns_like(columns, "[CPU%]") == ["cpu", "cpu_delta"]
    assert predicates.columns_like(columns, "[missing]") == []


def test_sleeping_levels(spark):
    rows = spark.createDataFrame(
        [(60, "sleeping", 0), (61, "sleeping", 1), (62, "running", 0), (9, "running", 0)],
        "session_id int, status string, open_tran_count int",
    )
    assert predicates.include_states(rows).count() == 1
    assert predicates.include_states(rows, sleeping=1).count() == 2
    assert predicates.include_states(rows, sleeping=2).count() == 3
    assert predicates.include_states(rows, sleeping=2, system=True).count() == 4


def test_boundaries_are_counted(spark):
    rows = _stamps(spark, "2024-01-01 00:00:00.9")
    end = F.lit("2024-01-01 00:00:01.1").cast("timestamp_ntz")
    assert rows.select(temporal.boundaries_between("second", F.col("t"), end)).head()[0] == 1
    assert rows.select(temporal.boundaries_between("millisecond", F.col("t"), end)).head()[0] == 200


def test_differences_ignore_the_session_zone(spark):
    """A clock change inside the span does not shorten a difference of wall-clock times."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = _stamps(spark, "2024-03-10 01:30:00")
        end = F.lit("2024-03-10 03:30:00").cast("timestamp_ntz")
        row = rows.select(
            temporal.boundaries_between("second", F.col("t"), end), temporal.micros_between(F.col("t"), end)
        ).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (7200, 7_200_000_000)


@pytest.mark.parametrize("kind", ["number", "text"])
def test_large_top_equals_small_top(spark, assert_same, monkeypatch, kind):
    rows = spark.range(500).select(((F.col("id") * 37) % 91).alias("k"), "id")
    if kind == "text":
        rows = rows.withColumn("k", F.col("k").cast("string"))
    small = ordering.top_n(rows, 200, F.desc("k"), "id")
    first = ordering.first_rows(rows.select("k"), "k", 200)
    key = ordering.nth_key(rows, "k", rows.selectExpr("min(k)").head()[0], 200).head()
    monkeypatch.setattr(ordering, "SMALL_TOP", 10)
    monkeypatch.setattr(ordering, "LEAF_ROWS", 10)
    assert_same(small, ordering.top_n(rows, 200, F.desc("k"), "id"))
    assert_same(first, ordering.first_rows(rows.select("k"), "k", 200))
    assert key == ordering.nth_key(rows, "k", rows.selectExpr("min(k)").head()[0], 200).head()


def test_narrow_text(spark):
    row = spark.range(1).select(
        conversion.text_of_width(F.lit(9999), 4), conversion.text_of_width(F.lit(10000), 4)
    ).head()
    assert tuple(row) == ("9999", "*")


def test_weak_password_rules_overlap(spark):
    rows = spark.createDataFrame([("password", "password"), ("bob", ""), ("eve", "s3cret")], "name string, p string")
    found = audit.weak_passwords(rows.select("name", F.sha2("p", 256).alias("password_digest")))
    assert sorted(map(tuple, found.collect())) == [
        ("bob", "blank"), ("password", "common password"), ("password", "same as login"),
    ]


def test_further_password_candidates(spark):
    rows = spark.createDataFrame([("bob", "hunter2")], "name string, p string")
    digests = rows.select("name", F.sha2("p", 256).alias("password_digest"))
    assert audit.weak_passwords(digests).count() == 0
    assert audit.weak_passwords(digests, {"leaked": "hunter2"}).head()["weakness"] == "leaked"


# --- antipattern thresholds ---------------------------------------------------


@pytest.mark.parametrize("terms,flagged", [(1, 0), (50, 0), (64, 0), (65, 1), (101, 1), (500, 1)])
@pytest.mark.parametrize("shape", ["in", "or"])
def test_term_threshold(spark, tables, terms, flagged, shape):
    def text(column, quote):
        values = [f"{quote}{i}{quote}" for i in range(1, terms + 1)]
        if shape == "in":
            return f"SELECT * FROM t WHERE {column} IN ({', '.join(values)})"
        return f"SELECT * FROM t WHERE {column} = " + f" OR {column} = ".join(values)

    log = spark.createDataFrame(
        [(1, text("views", "")), (2, text("views", "'")), (3, text("up_votes", ""))],
        "query_id int, query_sql_text string",
    )
    found = antipatterns.antipattern_scan(log, tables.column_types).collect()
    assert [(r.query_id, r.type_convert, r.large_number_of_or) for r in found] == [(1, 1, flagged)]


# --- keyset paging and batches --------------------------------------------------


def _keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k bigint")


def test_nth_key_at_the_end(spark):
    rows = _keys(spark, range(10))
    assert ordering.nth_key(rows, "k", 3, 4).head()[0] == 7
    assert ordering.nth_key(rows, "k", 3, 100).head()[0] == 9
    assert ordering.nth_key(rows, "k", 9, 4).head()[0] is None


@pytest.mark.parametrize("kind", ["spread", "hot low", "hot high", "all equal"])
def test_selected_key_equals_sorted_key(spark, monkeypatch, kind):
    monkeypatch.setattr(ordering, "LEAF_ROWS", 20)
    values = {
        "spread": [(i * 7919) % 5003 for i in range(5000)],
        "hot low": [5] * 2500 + list(range(2500)),
        "hot high": [10_000] * 3000 + list(range(2000)),
        "all equal": [7] * 3000,
    }[kind]
    rows = _keys(spark, values)
    for n in (1, 21, 1700, 2499, 2999):
        assert ordering.nth_key(rows, "k", -1, n).head()[0] == sorted(values)[n - 1]
        assert sorted(r.k for r in ordering.first_rows(rows, "k", n).collect()) == sorted(values)[:n]


def test_batches_of_unique_keys(spark):
    log = mutations.batch_log(_keys(spark, range(1, 26)), "k", 5, 8).orderBy("batch_no").collect()
    assert [tuple(r) for r in log] == [(1, 6, 13, 8), (2, 14, 21, 8), (3, 22, 25, 4)]


def test_batches_never_split_equal_keys(spark):
    rows = _keys(spark, [1, 2, 2, 2, 3, 4, 4, 5])
    log = mutations.batch_log(rows, "k", 0, 2).orderBy("batch_no").collect()
    assert [tuple(r) for r in log] == [(1, 1, 2, 4), (2, 3, 4, 3), (3, 5, 5, 1)]


def _batches(values, n):
    """A plain walk over sorted keys."""
    values, made, at = sorted(values), [], 0
    while at < len(values):
        end = min(at + n, len(values))
        while end < len(values) and values[end] == values[end - 1]:
            end += 1
        made.append((len(made) + 1, values[at], values[end - 1], end - at))
        at = end
    return made


@pytest.mark.parametrize("n", [1, 3, 40])
def test_batches_across_blocks(spark, monkeypatch, n):
    """Batches shorter and longer than a block, and keys that fill several blocks."""
    monkeypatch.setattr(mutations, "BLOCK_ROWS", 7)
    values = [k for k in range(60) for _ in range(30 if k in (4, 31) else 1 + k * k % 3)]
    rounds = []
    monkeypatch.setattr(mutations, "materialise", lambda df, label: rounds.append((label, made := materialise(df, label))) or made)
    log = mutations.batch_log(_keys(spark, [-1, None, *values]), "k", -1, n).orderBy("batch_no").collect()
    assert [tuple(r) for r in log] == _batches(values, n)
    if n == 1:
        # Only keys at the ends of blocks take part in the rounds.
        assert all(df.count() <= len(values) // 7 + 1 for label, df in rounds if label == "batches_met")


def test_batches_of_nothing(spark):
    kept, log = mutations.delete_in_batches(_keys(spark, [1, 2]), "k", 5, 2)
    assert kept.count() == 2
    assert log.count() == 0


def test_null_predicate_keeps_and_leaves_rows(spark):
    rows = spark.createDataFrame([(1, 5), (2, None)], "k int, v int")
    assert mutations.delete_where(rows, F.col("v") > 3).count() == 1
    updated = mutations.update_where(rows, F.col("v") > 3, "k", F.lit(9)).orderBy("k").collect()
    assert [tuple(r) for r in updated] == [(2, None), (9, 5)]


# --- snapshots ------------------------------------------------------------------


def test_snapshot_table_grows_wider(spark, work):
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "session_id int, collection_time timestamp_ntz")
    wider = first.withColumn("login_name", F.lit("x"))
    snapshots.create_snapshot_table(first, work)
    snapshots.append_snapshot(first, work)
    snapshots.append_snapshot(wider, work, dt.datetime(2024, 1, 2))
    everything = snapshots.read_snapshots(spark, work)
    assert set(everything.columns) == {"session_id", "collection_time", "login_name"}
    assert everything.where("login_name IS NULL").count() == 1
    assert snapshots.schema_ddl(first, "seen").startswith("CREATE TABLE seen (session_id int")


def test_snapshot_keeps_its_schema_when_empty(spark, work):
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "session_id int, collection_time timestamp_ntz")
    snapshots.create_snapshot_table(first, work)
    assert snapshots.read_snapshots(spark, work).columns == first.columns


def test_retyped_copy_cuts_text(spark):
    rows = spark.createDataFrame([(1, "abcdef", 7)], "id int, name string, views int")
    copy = source_tables.copy_retyped(rows, {"name": "varchar(3)", "views": "string"})
    assert tuple(copy.head()) == (1, "abc", "7")


def test_baseline_without_history(spark):
    history = spark.createDataFrame([], "q string, t bigint")
    now = spark.createDataFrame([("a", 5)], "q string, t bigint")
    assert activity_ops.average_time_baseline(history, now, "q", "t").head()["is_slower"] is None


# --- values a column can't hold -----------------------------------------------------


@pytest.mark.parametrize(
    "kind,value,held",
    [
        ("decimal(10,2)", 3.701, []), ("decimal(10,2)", 3.7, [1]), ("decimal(4,2)", 3700, []), ("decimal(10,2)", float("inf"), []),
        ("int", float("nan"), []), ("int", float("inf"), []), ("int", 3.0, [1]), ("int", 3.5, []), ("smallint", 40_000, []),
        ("tinyint", -128, []), ("bigint", 2**63, []), ("float", 0.1, []), ("float", 3.5, []), ("double", float("nan"), []),
    ],
)
def test_values_a_column_cannot_hold_equal_nothing(spark, kind, value, held):
    number = "3.7" if kind.startswith("decimal") else "3"
    df = spark.sql(f"SELECT 1 AS id, CAST({number} AS {kind}) AS v UNION ALL SELECT 2, CAST(NULL AS {kind})")
    for rows in (
        predicates.filter_equal_typed(df, "v", value), predicates.filter_null_or(df, "v", value), predicates.filter_optional(df, "v", value),
        predicates.filter_null_safe(df, "v", value), predicates.filter_null_sentinel(df, "v", value, 1),
    ):
        assert [r.id for r in rows.collect()] == held


def test_blockers_without_a_number_stand_beside_session_zero(spark):
    """Null for the blocker means session 0, if there is one."""
    at = dt.datetime(2024, 1, 1)
    rows = [(at, 0, "a", "LCK_M_X", None), (at, 1, "a", "LCK_M_S", None), (at, 2, "a", "PAGEIOLATCH", 1), (at, 3, "a", "WRITELOG", None)]
    snap = spark.createDataFrame(rows, "collection_time timestamp_ntz, session_id int, login_name string, wait_info string, blocking_session_id int")
    got = activity_ops.snapshot_blockers(snap, at, at, ["x"]).collect()
    assert [(r.blocker_session_id, r.blocked_session_id) for r in got] == [(0, 3), (1, 2)]
    without = activity_ops.snapshot_blockers(snap.where("session_id > 0"), at, at, ["x"]).collect()
    assert [(r.blocker_session_id, r.blocked_session_id) for r in without] == [(1, 2)]


def test_members_of_roles_inside_roles(spark):
    pairs = [("admin", "a"), ("admin", "ops"), ("ops", "b"), ("ops", "dev"), ("dev", "ops"), ("dev", "c"), ("other", "d"), ("admin", "a"), ("ops", None), ("admin", "admin")]
    members = spark.createDataFrame(pairs, "role_name string, member_name string")
    assert sorted(r.name for r in audit.members_of(members, "admin").collect()) == ["a", "admin", "b", "c", "dev", "ops"]
    assert sorted(r.name for r in audit.members_of(members, "dev").collect()) == ["b", "c", "dev", "ops"]
    assert audit.members_of(members, "nobody").count() == 0


def test_patterns_with_backslashes_find_query_texts(spark):
    queries = spark.createDataFrame([(1, 10), (2, 20)], "query_id int, query_text_id int")
    texts = spark.createDataFrame([(10, "SELECT 'CORP\\ann'"), (20, "SELECT 1")], "query_text_id int, query_sql_text string")
    assert [r.query_id for r in history.query_by_text(queries, texts, "%CORP\\a%").collect()] == [1]


# Texts like those of the demos, with the column and the flag expected of them.
def _ones(n, gap=", ", value="1"):
    return gap.join([value] * n)


ANTIPATTERNS = [
    (f"SELECT *\nFROM U\nWHERE [Views] IN (\n    {_ones(65, ',' + chr(10))}\n);", ("views", 1)),
    (f"SELECT * FROM U WHERE [dbo].[U].[Views] IN ({_ones(64, ',')})", ("views", 0)),
    ("SELECT * FROM U WHERE Views = 1" + " OR [Views]  = 2" * 64, ("views", 1)),
    ("SELECT * FROM U WHERE id=5 AND (u.views=1" + " OR\n u.views=2" * 63 + ")", ("views", 0)),
    ("SELECT * FROM U WHERE id=5 AND ((u.views=1)" + " OR (u.views=2)" * 64 + ") ORDER BY x", ("views", 1)),
    (f"-- WHERE views IN (1)\nSELECT a /* where views = 1 */ FROM U WHERE up_votes IN ({_ones(90)})", None),
    ("SELECT Id FROM U WHERE DisplayName = N'it''s'", ("displayname", 0)),
    ("SELECT Id FROM U WHERE DisplayName = '??' + N'?'", ("displayname", 0)),
    ("SELECT Id FROM U WHERE DisplayName + N'?' = N'??'", None),
    ("SELECT Id FROM U WHERE DisplayName = '??'", None),
    ("SELECT Id FROM U WHERE Views = N'1'", None),
    ("UPDATE t SET views = 1 WHERE id = 3", None),
    ("SELECT " + ", ".join(f"c{i}" for i in range(70)) + " FROM t WHERE views = 1", ("views", 0)),
    ("SELECT * FROM t WHERE 1 = views", ("views", 0)),
    ("SELECT * FROM t WHERE abs(views) = 1 AND len(views) IN (1,2)", None),
    (f"SELECT * FROM t WHERE views NOT IN ({_ones(90)})", ("views", 0)),
    ("SELECT * FROM t WHERE views BETWEEN 1 AND 5", ("views", 0)),
    ("SELECT * FROM t JOIN s ON t.a = s.b AND t.views = -7 WHERE t.c = 'x'", ("views", 0)),
    ("SELECT * FROM t WHERE a IN (SELECT b FROM s WHERE views IN (1,2)) AND c = 1", ("views", 0)),
    ("SELECT * FROM t WHERE views = @p", None),
    (f"SELECT * FROM t WHERE views IN ({_ones(30)}) OR views IN ({_ones(35)})", ("views", 1)),
    (f"SELECT * FROM t WHERE views IN ({_ones(50)}) AND views IN ({_ones(50)})", ("views", 0)),
    ('SELECT * FROM t WHERE "odd [name]" = 1', ("odd [name]", 0)),
    (None, None),
    ("", None),
    ("SELECT * FROM t WHERE views = views + 1", None),
    (f"SELECT 1 WHERE views IN ({_ones(200_000)})", ("views", 1)),
    ("SELECT 1 WHERE " + _ones(50_000, " OR ", "views = 1"), ("views", 1)),
    ("/*" + "x*" * 300_000 + "*/ SELECT 1 WHERE views = 1", ("views", 0)),
]


def test_antipatterns_in_any_spelling(spark):
    log = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ANTIPATTERNS)], "query_id int, query_sql_text string")
    kinds = [("views", "nvarchar"), ("up_votes", "int"), ("displayname", "varchar"), ("odd [name]", "text")]
    types = spark.createDataFrame(kinds, "column_name string, type_name string")
    found = {r.query_id: (r.compared_column, r.large_number_of_or) for r in antipatterns.antipattern_scan(log, types).collect()}
    assert found == {i: flags for i, (_, flags) in enumerate(ANTIPATTERNS) if flags}
