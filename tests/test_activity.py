"""Counts of active members, whole and kept up from day to day, against plain sums."""

import random

import pytest

from tidemark.operators import activity as A
from tidemark.operators.hierarchy import group_activity
from tidemark.operators.links import direct_activity
from tidemark.scratch import materialize


def brute(parent, direct):
    """Sums over all groups that reach a group, itself included."""
    below = dict.fromkeys(parent, 0)
    for node in parent:
        at, seen = node, set()
        while at in parent and at not in seen:
            below[at] += direct.get(node, 0)
            seen.add(at)
            at = parent[at]
    return below


def frames(spark, parent, direct):
    forest = spark.createDataFrame([(k, p) for k, p in parent.items()], "group_id bigint, parent_group_id bigint").coalesce(2)
    return forest, spark.createDataFrame([(k, n) for k, n in direct.items() if n], "group_id bigint, direct bigint").coalesce(1)


def as_dict(df):
    return {r.group_id: (r.parent_group_id, r.direct, r.below) for r in df.collect()}


def expected(parent, direct):
    return {k: (parent[k], direct.get(k, 0), n) for k, n in brute(parent, direct).items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_equal_full_counts_day_after_day(spark, seed):
    rng = random.Random(seed)
    parent = {n: rng.choice([None, *range(40)]) for n in range(40)}
    direct = {n: rng.choice([0, 0, 1, 3]) for n in range(40)}
    stored = materialize(A.count_activity(*frames(spark, parent, direct)), "counts")
    assert as_dict(stored) == expected(parent, direct)
    for _ in range(2):
        for node in rng.sample(range(45), 5):
            change = rng.random()
            if change < 0.25:
                parent.pop(node, None)
            elif change < 0.6:
                parent[node] = rng.choice([None, *range(45)])
            else:
                direct[node] = rng.choice([0, 2])
        counts, _ = A.update_activity(stored, *frames(spark, parent, direct))
        stored = materialize(counts, "counts")
        assert as_dict(stored) == expected(parent, direct)


def test_only_ancestors_of_a_change_are_counted_anew(spark):
    parent = {n: (n - 1) // 2 if n else None for n in range(200)}
    direct = dict.fromkeys(range(100, 200), 1)
    stored = materialize(A.count_activity(*frames(spark, parent, direct)), "counts")
    direct[150] = 0
    moved = {**parent, 77: 3}
    counts, fresh = A.update_activity(stored, *frames(spark, moved, direct))
    assert as_dict(counts) == expected(moved, direct)
    above = {150, 74, 36, 17, 8, 3, 1, 0, 77, 38, 18}
    assert {r.group_id for r in fresh.collect()} == above
    same, none = A.update_activity(stored, *frames(spark, parent, {**direct, 150: 1}))
    assert none.isEmpty() and as_dict(same) == as_dict(stored)


def test_a_hot_parent_and_an_empty_forest(spark):
    parent = {0: None} | {n: 0 for n in range(1, 500)}
    direct = dict.fromkeys(range(1, 500), 2)
    counts = A.count_activity(*frames(spark, parent, direct))
    assert {r.group_id: r.below for r in counts.filter("group_id = 0").collect()} == {0: 998}
    none = frames(spark, {}, {})
    assert A.count_activity(*none).isEmpty()
    emptied, _ = A.update_activity(materialize(counts, "counts"), *none)
    assert emptied.isEmpty()


def test_status_is_that_of_propagation(spark, rows):
    parent = {1: None, 2: 1, 3: 2, 4: 1, 5: 6, 6: 5, 7: 5}
    members = rows("group_id bigint, user_id bigint, user_status string", (3, 9, "active"), (3, 9, "active"), (7, 1, "active"), (4, 2, "inactive"))
    forest, _ = frames(spark, parent, {})
    counts = A.count_activity(forest, A.direct_counts(members))
    status = {r.group_id: r.status for r in A.status_of(counts).collect()}
    assert status == {r.group_id: r.status for r in group_activity(forest, direct_activity(members)).collect()}
    assert {r.group_id: r.below for r in counts.collect()} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1, 7: 1}


def test_a_store_with_counts_syncs_the_same_groups(spark, tmp_path):
    from tests.two_days import write_days
    from tidemark.plans import groups as group_plan, users
    from tidemark.schemas import COUNTED_TABLES, COUNTS
    from tidemark.sources.state import StateStore

    write_days(tmp_path / "dumps")
    groups = []
    for name, tables in (("plain", {}), ("counted", {"tables": COUNTED_TABLES})):
        store = StateStore(spark, str(tmp_path / name), buckets=2, **tables)
        for day in ("day1", "day2"):
            users.run(spark, str(tmp_path / "dumps"), day, store)
            group_plan.run(spark, str(tmp_path / "dumps"), day, store)
            groups.append(sorted(map(tuple, store.read("groups").collect()), key=str))
    assert groups[:2] == groups[2:]
    # The second day's users 11 and 16 are gone; group 3 moved below group 2.
    assert {r.group_id: (r.parent_group_id, r.direct, r.below) for r in store.read(COUNTS).collect()} == {
        1: (None, 3, 9), 2: (1, 0, 2), 3: (2, 2, 2), 4: (1, 2, 2), 5: (1, 2, 2)
    }


def test_a_count_of_a_bushy_forest_writes_its_rows_about_twice(spark, monkeypatch):
    parent = {n: (n - 1) // 2 if n else None for n in range(600)} | {700: 701, 701: 700, 702: 700, 703: 703, 704: 999}
    direct = dict.fromkeys(range(0, 705, 3), 2)
    written = []
    measured = A.measured

    def counted(df, label, **figures):
        table, seen = measured(df, label, **figures)
        written.append(seen["rows"])
        return table, seen

    monkeypatch.setattr(A, "measured", counted)
    direct = {k: n for k, n in direct.items() if k in parent}
    assert as_dict(A.count_activity(*frames(spark, parent, direct))) == expected(parent, direct)
    assert sum(written) <= 2.5 * len(parent)
