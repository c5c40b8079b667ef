from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import reconcile as R


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_snapshot_reconcile_marks_missing_and_returning(spark, rows):
    new = rows("user_id bigint, name string", (101, "new name"), (102, "other"), (103, None))
    old = rows("user_id bigint, name string, status string", (101, "old", "inactive"), (999, "gone", "active"),
               (103, "kept", "active"))
    got = as_set(R.reconcile_snapshot(new, old, ["user_id"], coalesce_cols=["name"]))
    assert got == {(101, "new name", "active"), (102, "other", "active"), (103, "kept", "active"),
                   (999, "gone", "inactive")}


def test_source_wins_clears_and_keep_holds(spark, rows):
    new = rows("id int, parent int, made int", (1, None, 9), (2, 5, 9))
    old = rows("id int, parent int, made int", (1, 7, None))
    got = as_set(R.reconcile_snapshot(new, old, ["id"], source_wins_cols=["parent"], keep_cols=["made"]))
    assert got == {(1, None, None, "active"), (2, 5, 9, "active")}


def test_merge_upsert_inserts_updates_and_defaults(spark, rows):
    target = rows("k int, a string, b string, c int", (1, "a1", "b1", 1), (2, "a2", "b2", 2))
    source = rows("k int, a string, b string", (2, None, "x"), (3, "a3", "b3"))
    merged = R.merge_upsert(target, source, ["k"], ["a"], defaults={"c": F.lit(0)})
    assert as_set(merged) == {(1, "a1", "b1", 1), (2, None, "b2", 2), (3, "a3", "b3", 0)}
    assert merged.columns == target.columns
    assert as_set(R.merge_upsert(merged, source, ["k"], ["a"], defaults={"c": F.lit(0)})) == as_set(merged)


def test_merge_with_an_empty_source_is_the_identity(spark, rows):
    target = rows("k int, a string", (1, "a1"))
    assert as_set(R.merge_upsert(target, target.limit(0), ["k"], ["a"])) == {(1, "a1")}


def test_replace_children_clears_a_parent_that_lost_all(spark, rows):
    links = rows("p int, c int", (1, 10), (1, 11), (2, 20), (3, 30))
    batch = rows("p int, c int", (1, 12))
    assert as_set(R.replace_children(links, batch, "p")) == {(1, 12), (2, 20), (3, 30)}
    synced = rows("p int", (1,), (2,))
    assert as_set(R.replace_children(links, batch, "p", synced)) == {(1, 12), (3, 30)}


def test_delta_is_null_safe_and_takes_more_columns(spark, rows):
    incoming = rows("id int, amount double, shop string", (1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (4, None, "d"))
    stored = rows("id int, amount double, shop string", (1, 1.0, "a"), (2, None, "b"), (3, 3.0, "z"), (4, None, "d"))
    assert {r.id for r in R.delta_detect(incoming, stored, ["id"], ["amount"]).collect()} == {2}
    assert {r.id for r in R.delta_detect(incoming, stored, ["id"], ["amount", "shop"]).collect()} == {2, 3}
    assert R.delta_detect(incoming, stored.limit(0), ["id"], ["amount"]).count() == 4


def test_dedup_latest_is_the_same_in_any_order_and_limits_before_the_shuffle(spark, rows):
    data = [(1, date(2024, 1, 1), "b"), (1, date(2024, 1, 2), "z"), (1, date(2024, 1, 2), "y"), (2, None, "n")]
    for order in (data, data[::-1]):
        df = rows("k int, at date, v string", *order)
        assert as_set(R.dedup_latest(df, ["k"], ["at"])) == {(1, date(2024, 1, 2), "y"), (2, None, "n")}
    plan = R.dedup_latest(df.repartition(3), ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    lower = plan[plan.index("Exchange hashpartitioning(k"):]
    assert "WindowGroupLimit" in lower and "Partial" in lower


def test_dedup_on_the_key_alone(spark, rows):
    assert R.dedup_latest(rows("k int", (1,), (1,)), ["k"]).count() == 1


def test_left_enrich_takes_one_details_record(spark, rows):
    index = rows("id string", ("1",), ("2",))
    details = rows("id string, at string, v string", ("1", "a", "old"), ("1", "b", "new"))
    got = R.left_enrich(index, details, "id", ["at"]).select("id", "det.v")
    assert as_set(got) == {("1", "new"), ("2", None)}
