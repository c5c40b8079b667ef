import json
from datetime import datetime

import pytest

from tests.two_days import _payment, _write, write_days
from tidemark.operators import quality as Q
from tidemark.plans import transactions
from tidemark.plans.day import sync_day, sync_days
from tidemark.schemas import TABLES
from tidemark.operators.reconcile import merge_upsert
from tidemark.scratch import materialize
from tidemark.sources.state import StateStore

NOW = datetime(2026, 1, 6, 12)


def table(store, name):
    return sorted(map(tuple, store.read(name).collect()), key=str)


def everything(store):
    return {name: table(store, name) for name in TABLES}


@pytest.fixture(scope="module")
def synced(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dumps")
    write_days(root)
    store = StateStore(spark, str(tmp_path_factory.mktemp("state")))
    sync_day(spark, str(root), "day1", store, NOW)
    first = everything(store)
    sync_day(spark, str(root), "day2", store, NOW)
    second = everything(store)
    return root, store, first, second


def test_first_day_fills_every_table(synced):
    _, _, first, _ = synced
    assert {name: len(rows) for name, rows in first.items()} == {
        "users": 6, "roles": 4, "user_roles": 9, "groups": 5, "group_members": 17, "cards": 6, "budgets": 4,
        "transactions": 7, "transaction_cards": 7, "transaction_budgets": 7,
    }
    assert {row[3] for row in first["users"]} == {"active"}
    assert {row[4] for row in first["groups"]} == {"active"}
    pound = next(row for row in first["transactions"] if row[0] == "t7")
    assert (str(pound[3]), pound[4], str(pound[6]), pound[5]) == ("125.59", "GBP", "158.97", 1 / 0.79)
    assert {str(row[2]) for row in first["transactions"]} == {"2026-01-05"}
    assert {row[10] for row in first["transactions"]} == {NOW}


def test_second_day_marks_the_missing_users(synced):
    _, _, first, second = synced
    assert {row[0]: row[3] for row in second["users"]} == {
        11: "inactive", 12: "active", 13: "active", 14: "active", 15: "active", 16: "inactive"
    }
    # The links of users who left stay as they are.
    assert second["user_roles"] == first["user_roles"]
    assert second["roles"] == first["roles"]


def test_second_day_moves_a_group_and_spreads_its_activity(synced):
    _, _, _, second = synced
    groups = {row[0]: row for row in second["groups"]}
    assert groups[3][3] == 2
    assert {key: row[4] for key, row in groups.items()} == dict.fromkeys(range(1, 6), "active")
    members = second["group_members"]
    assert len(members) == 17
    assert sum(row[2] == "active" for row in members) == 9
    assert (1, 99, "inactive") in members


def test_unknown_member_is_reported(synced):
    _, store, _, _ = synced
    lost = Q.orphans(store.read("group_members"), store.read("users"), {"user_id": "user_id"})
    assert [(r.group_id, r.user_id) for r in lost.collect()] == [(1, 99)]


def test_day_without_transactions_leaves_them(synced):
    _, _, first, second = synced
    for name in ("transactions", "cards", "budgets", "transaction_cards", "transaction_budgets"):
        assert second[name] == first[name]


def test_rerun_changes_nothing(spark, synced):
    root, store, _, second = synced
    sync_day(spark, str(root), "day2", store, datetime(2027, 1, 1))
    assert everything(store) == second
    for name, spec in TABLES.items():
        assert Q.duplicate_keys(store.read(name), spec.keys).isEmpty()


def test_a_new_session_of_the_store_reads_the_same(spark, synced):
    _, store, _, second = synced
    assert everything(StateStore(spark, store.root)) == second


def test_merge_does_not_shuffle_the_stored_side(spark, synced):
    root, store, _, _ = synced
    entry = store._entries["users"]
    files = [r for r in spark.read.format("binaryFile").load(entry["path"]).select("path").collect()]
    assert len(files) <= store.buckets
    new = materialize(store.read("users").limit(3))
    merged = merge_upsert(store.read("users"), new, ["user_id"], ["status"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # The only exchange is the one of the incoming rows.
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("Bucketed: true")


def test_junctions_of_later_transactions_are_kept(spark, synced):
    """New and changed transactions on a filled state: fact, dimensions and junctions all get their rows."""
    root, store, first, _ = synced
    _write(root, "day3", "cards", "1.json", {"results": [
        {"id": "c1", "name": "renamed", "lastFour": "9999", "type": "PHYSICAL", "status": "FROZEN"},
        {"id": "c7", "lastFour": "0007", "type": "VIRTUAL", "status": "ACTIVE"},
    ]})
    _write(root, "day3", "budgets", "1.json", {"results": [
        {"id": "b1", "name": "budget one"}, {"id": "b5", "name": "budget 5"},
    ]})
    page = [
        _payment("t1", "2310", 2, "USD", "c1", "b1", merchantName="other shop"),  # amount as before: left alone
        _payment("t2", "150000", 2, "USD", "c1", "b1", transactionType="REFUND"),  # changed
        _payment("t8", "1005", 3, "USD", "c7", "b5"),  # new
        _payment("t9", "100", 0, "EUR", "c7", "b5"),  # no rate that day
        _payment("t10", "NaN", 0, "USD", "c7", "b5"), _payment("t11", "1e40", 0, "USD", "c7", "b5"),
        _payment("t12", "-1", 0, "USD", "c7", "b5"), _payment("t13", "1", 0, "usd", "", "b5"),
        _payment("t14", "1", 0, "USD", "c7", "b5", occurredTime=None),
    ]
    _write(root, "day3", "transactions", "1.json", {"results": page})
    _write(root, "day3", "transactions", "2.json", '{"results": [{"id": "cut')
    before = {row[0]: row for row in table(store, "transactions")}
    transactions.run(spark, str(root), "day3", store, datetime(2026, 1, 8))
    after = {row[0]: row for row in table(store, "transactions")}
    assert set(after) - set(before) == {"t8"}
    assert after["t1"] == before["t1"]
    assert str(after["t2"][3]) == "1500.00" and after["t2"][1] == "AUTHORIZATION" and after["t2"][10] == NOW
    assert str(after["t8"][3]) == "1.01" and after["t8"][10] == datetime(2026, 1, 8)
    links = {(row[0], row[1]) for row in table(store, "transaction_cards")}
    assert {("t8", "c7"), ("t2", "c1"), ("t2", "c2")} <= links
    assert ("t8", "b5") in {(row[0], row[1]) for row in table(store, "transaction_budgets")}
    cards = {row[0]: row for row in table(store, "cards")}
    assert cards["c1"] == ("c1", "renamed", "0001", "VIRTUAL", "FROZEN")
    bad = store.records("quarantine").filter("day = 'day3' and entity = 'transactions'")
    reasons = {}
    for row in bad.collect():
        reasons[json.loads(row.record).get("transaction_id")] = sorted(row.reasons)
    assert reasons == {
        "t9": ["no_rate"], "t10": ["bad_amount"], "t11": ["bad_amount"], "t12": ["bad_amount"],
        "t13": ["missing_card_id", "unknown_currency_code"], "t14": ["bad_date"],
        None: sorted(["corrupt_record", "missing_transaction_id", "missing_card_id", "missing_budget_id",
                      "bad_amount", "unknown_currency_code", "bad_date"]),
    }
    counts = {r.stage: (r.rows_in, r.rows_ok, r.rows_failed)
              for r in store.records("metrics").filter("day = 'day3'").collect()}
    assert counts == {"transactions": (10, 4, 6), "conversion": (3, 2, 1)}


def test_every_merged_table_keeps_one_file_per_bucket(spark, synced):
    _, store, _, _ = synced
    for name, spec in TABLES.items():
        if spec.bucketed:
            files = spark.read.format("binaryFile").load(store._entries[name]["path"]).select("path").count()
            assert files <= store.buckets, name


def test_returning_user_becomes_active(spark, synced, tmp_path):
    root, store, _, _ = synced
    sync_days(spark, str(root), ["day1"], store, NOW)
    assert {row[3] for row in table(store, "users")} == {"active"}
    assert {row[0]: row[3] for row in table(store, "groups")}[3] == 1
