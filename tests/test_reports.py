"""What runs record: rows in balance over all stages, references that lead nowhere, circles, statuses; and rows that come late."""

import itertools
from datetime import datetime

from tests.two_days import _group, _payment, _write, write_days
from tidemark.operators import quality as Q
from tidemark.operators import reconcile as R
from tidemark.plans import transactions
from tidemark.plans.day import sync_day
from tidemark.sources.state import StateStore

NOW = datetime(2026, 1, 6)


def test_day_reports(spark, tmp_path):
    write_days(tmp_path / "dumps")
    root = str(tmp_path / "dumps")
    _write(tmp_path / "dumps", "day2", "admin_groups", "2.json", [
        _group(7, "a", 8, [12, 12]), _group(8, "b", 7, [500]), _group(9, "c", 404, []), _group(9, "c again", 404, []), _group(6, "", None, []),
    ])
    again = _payment("t2", "100", 2, "USD", "c2", "b2", updatedTime="2026-01-05T11:00:00Z")
    _write(tmp_path / "dumps", "day2", "transactions", "1.json", [
        _payment("t1", "2310", 2, "USD", "c1", "b1"), again, {**again, "updatedTime": "2026-01-05T10:00:00Z"},
        _payment("t3", "1", 2, "USD", "c3", "b2", updatedTime="2026-01-04T00:00:00Z"),
        _payment("t4", "640", 2, "USD", "c4", "b3", updatedTime="2026-01-06T00:00:00Z"),
        _payment("n1", "5", 2, "EUR", "c1", "b1"), _payment("n2", "5", 2, "USD", "", "b1"),
    ])
    store = StateStore(spark, str(tmp_path / "state"), buckets=2)
    for day in ("day1", "day2"):
        sync_day(spark, root, day, store, NOW)
    lines = store.records("balance").filter("day = 'day2'").collect()
    for r in lines:
        assert r.rows_in == r.rows_ok + r.rows_failed + r.rows_skipped
    for entity in ("users", "groups", "transactions"):
        steps = sorted((r for r in lines if r.entity == entity), key=lambda r: r.step)
        assert all(a.rows_ok == b.rows_in for a, b in itertools.pairwise(steps))
    assert {(r.entity, r.stage): (r.rows_in, r.rows_ok, r.rows_failed, r.rows_skipped) for r in lines} == {
        ("users", "users"): (4, 4, 0, 0), ("users", "unique"): (4, 4, 0, 0), ("groups", "groups"): (10, 9, 1, 0),
        ("groups", "unique"): (9, 8, 0, 1), ("transactions", "extracted"): (7, 6, 0, 1), ("transactions", "transactions"): (6, 5, 1, 0),
        ("transactions", "delta"): (5, 2, 0, 3), ("transactions", "conversion"): (2, 1, 1, 0),
    }
    late = next(r for r in lines if r.stage == "delta")
    assert "1 of them late" in late.skipped_as
    stored = {r.transaction_id: (str(r.original_amount), r.updated_at) for r in store.read("transactions").collect()}
    assert stored["t3"] == ("75.00", datetime(2026, 1, 5, 9, 20)) and stored["t4"] == ("6.40", datetime(2026, 1, 6))
    assert stored["t2"] == ("1.00", datetime(2026, 1, 5, 11))
    assert {r.group_id for r in store.records("cycles").filter("day = 'day2'").collect()} == {7, 8}
    found = {r.reference: (r.row_count, r.null_rows, r.orphan_rows, r.orphan_keys) for r in store.records("integrity").filter("day = 'day2'").collect()}
    assert found["groups.parent_group_id -> groups.group_id"] == (8, 1, 1, 1)
    assert found["group_members.user_id -> users.user_id"] == (19, 0, 2, 2)
    assert found["transactions.card_id -> cards.card_id"] == (7, 0, 0, 0) and len(found) == 11
    status = {(r.table, r.status): r.rows for r in store.records("statuses").filter("day = 'day2'").collect()}
    assert status["users", "inactive"] == 2 and status["users", "active"] == 4


def test_files_in_any_order_end_the_same(spark, tmp_path):
    versions = [("t1", "100", "09:00"), ("t1", "200", "10:00"), ("t1", "100", "11:00"), ("t2", "5", "08:00"), ("t2", "5", "12:00"), ("t2", "7", "11:30")]
    files = [versions[:1] + versions[3:4], versions[1:2] + versions[5:6], versions[2:3] + versions[4:5]]
    for k, rows_ in enumerate(files):
        _write(tmp_path, f"d{k}", "transactions", "1.json", [
            _payment(i, amount, 2, "USD", "c1", "b1", updatedTime=f"2026-01-05T{at}:00Z") for i, amount, at in rows_
        ])
    ends = set()
    for order in itertools.permutations(range(3)):
        store = StateStore(spark, str(tmp_path / f"state{order}"), buckets=2)
        for k in order:
            transactions.run(spark, str(tmp_path), f"d{k}", store, NOW)
        ends.add(frozenset((r.transaction_id, str(r.original_amount), r.updated_at) for r in store.read("transactions").collect()))
    assert ends == {frozenset({("t1", "1.00", datetime(2026, 1, 5, 11)), ("t2", "0.05", datetime(2026, 1, 5, 12))})}


def test_outcomes(spark, rows):
    stored = rows("k int, v int, at int", (1, 5, 10), (2, 5, 10), (3, 5, 10), (4, 5, None), (5, 5, 10), (6, 5, 10))
    incoming = rows("k int, v int, at int, more string", (1, 6, 9, "a"), (2, 6, 10, "a"), (3, 5, 11, "a"), (4, 5, 1, "a"), (5, 5, 10, "a"), (6, 6, None, "a"), (7, 1, None, "a"))
    got = {r.k: r.outcome for r in R.classify_delta(incoming, stored, ["k"], ["v"], "at").collect()}
    assert got == {1: "late", 2: "changed", 3: "newer", 4: "newer", 5: "same", 6: "changed", 7: "new"}
    plain = {r.k: r.outcome for r in R.classify_delta(incoming, stored, ["k"], ["v"]).collect()}
    assert plain == {1: "changed", 2: "changed", 3: "same", 4: "same", 5: "same", 6: "changed", 7: "new"}


def test_references_in_one_aggregation(spark, rows):
    frames = {"a": rows("x string, y bigint", ("1", 1), ("1", 2), (None, 9), ("7", 9)), "b": rows("k bigint", (1,), (2,), (None,))}
    checked = Q.check_references(frames, [Q.Reference("a", "x", "b", "k"), Q.Reference("a", "y", "b", "k")])
    assert {tuple(r) for r in checked.collect()} == {("a.x -> b.k", 4, 1, 1, 1), ("a.y -> b.k", 4, 0, 2, 1)}
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_a_second_run_parses_no_file_and_a_third_only_the_new_one(spark, tmp_path, monkeypatch):
    from tidemark.plans import groups, inputs, users
    from tidemark.sources import snapshots

    write_days(tmp_path)
    store = StateStore(spark, str(tmp_path / "state"), buckets=2)
    version = sync_day(spark, str(tmp_path), "day1", store, NOW, with_report=False, only_new=True)
    read, taken = snapshots.read_entity, []

    def spy(spark, root, day, entity, schema, multiline=None, files=None):
        taken.append((entity, files))
        return read(spark, root, day, entity, schema, multiline, files)

    for module in (inputs, users, groups, transactions):
        monkeypatch.setattr(module, "read_entity", spy)
    assert sync_day(spark, str(tmp_path), "day1", store, NOW, only_new=True) == version and taken == []
    _write(tmp_path, "day1", "transactions", "2.json", [_payment("t8", "100", 2, "USD", "c1", "b1")])
    assert sync_day(spark, str(tmp_path), "day1", store, NOW, with_report=False, only_new=True) == version + 1
    assert [(e, [f.rsplit("/", 1)[-1] for f in files]) for e, files in taken if files is not None] == [("transactions", ["2.json"])]
    assert store.read("transactions").count() == 8
    ledger = store.records("files")
    assert ledger.filter("entity = 'transactions'").count() == 2 and ledger.filter("entity = 'agents'").count() == 1
