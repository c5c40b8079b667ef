from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.plans import groups, transactions, users
from tidemark.schemas import RAW, TABLES, empty
from tidemark.sources.state import StateStore


def stored_groups(spark, *lines):
    return spark.createDataFrame(
        [(key, f"g{key}", None, parent, "active", None, None) for key, parent in lines], TABLES["groups"].schema
    )


def dump(rows, *lines):
    return Q.good_rows(groups.clean_groups(rows(
        "id bigint, name string, parent_group_id bigint, agent_ids array<bigint>", *lines)))


def people(spark, *ids):
    return spark.createDataFrame([(i, "n", "e", "active", None, None) for i in ids], TABLES["users"].schema)


def test_missing_group_and_memberless_group_are_inactive(spark, rows):
    sync = groups.build_groups(dump(rows, (2, "two", None, [])), people(spark), stored_groups(spark, (1, None), (2, None)),
                               empty(spark, TABLES["group_members"].schema))
    assert {r.group_id: r.status for r in sync.groups.collect()} == {1: "inactive", 2: "inactive"}


def test_activity_through_stored_groups_is_a_choice(spark, rows):
    """1 <- 2 <- 3 where the dump lacks 2: its stored pointer carries activity only when asked to."""
    good = dump(rows, (1, "top", None, []), (3, "low", 2, [7]))
    stored, none = stored_groups(spark, (2, 1)), empty(spark, TABLES["group_members"].schema)
    plain = groups.build_groups(good, people(spark, 7), stored, none)
    assert {r.group_id: r.status for r in plain.groups.collect()} == {1: "inactive", 2: "inactive", 3: "active"}
    linked = groups.build_groups(good, people(spark, 7), stored, none, include_stored=True)
    assert {r.group_id: r.status for r in linked.groups.collect()} == {1: "active", 2: "inactive", 3: "active"}


def test_group_moved_to_the_root_and_cleared_members(spark, rows):
    good = dump(rows, (2, "two", None, []))
    links = spark.createDataFrame([(2, 7, "active"), (5, 7, "active")], TABLES["group_members"].schema)
    sync = groups.build_groups(good, people(spark), stored_groups(spark, (2, 1)), links)
    assert sync.groups.first().parent_group_id is None
    assert [r.group_id for r in sync.group_members.collect()] == [5]
    kept = groups.build_groups(good, people(spark), stored_groups(spark, (2, 1)), links, clear_empty_parents=False)
    assert sorted(r.group_id for r in kept.group_members.collect()) == [2, 5]


def test_circular_groups_share_activity_and_end(spark, rows):
    good = dump(rows, (1, "a", 2, []), (2, "b", 3, [7]), (3, "c", 1, []), (4, "d", 1, []))
    sync = groups.build_groups(good, people(spark, 7), stored_groups(spark), empty(spark, TABLES["group_members"].schema))
    assert {r.group_id: r.status for r in sync.groups.collect()} == {1: "active", 2: "active", 3: "active", 4: "inactive"}


def test_same_user_twice_and_roles_without_a_file(spark, rows):
    index = rows("id string, name string, email string, updated_at string",
                 ("1", "old", "o@example.org", "2020-01-01T00:00:00Z"), ("1", "new", "n@example.org", "2021-01-01T00:00:00Z"))
    details = rows("id string, contact struct<name: string, email: string>, role_ids array<string>", ("1", (None, None), ["r1"]))
    good = Q.good_rows(users.clean_users(users.resolve_users(index, details)))
    no_users, no_links = empty(spark, TABLES["users"].schema), empty(spark, TABLES["user_roles"].schema)
    sync = users.build_users(good, empty(spark, RAW["roles"]), no_users, no_links)
    assert [(r.user_id, r.user_name) for r in sync.users.collect()] == [(1, "new")]
    assert [tuple(r) for r in sync.user_roles.collect()] == [(1, "r1", None)] and sync.roles.isEmpty()
    strict = users.build_users(good, empty(spark, RAW["roles"]), no_users, no_links, keep_unnamed_roles=False)
    assert strict.user_roles.isEmpty()


def test_missing_rate_may_count_as_one(spark, rows):
    delta = rows("transaction_id string, currency_code string, transaction_date date, original_amount decimal(18,2)") \
        .unionByName(spark.sql("select 't' transaction_id, 'EUR' currency_code, date'2024-01-01' transaction_date, 5.00BD original_amount"))
    none = transactions.no_rates(spark)
    assert transactions.convert(delta, none).first().reasons == ["no_rate"]
    kept = transactions.convert(delta, none, on_missing="one").first()
    assert (kept.reasons, kept.exchange_rate, str(kept.amount_usd)) == ([], 1.0, "5.00")


def test_first_load_then_unchanged_load(spark, rows, tmp_path):
    raw = spark.createDataFrame([("t", "AUTH", None, "2024-01-01", "u", "m", ("100", "2", "USD"), "c", "b")], RAW["transactions"])
    cards = spark.createDataFrame([("c", "card", "1", "v", "s")], TABLES["cards"].schema)
    budgets = spark.createDataFrame([("b", "n", None)], TABLES["budgets"].schema)
    store = StateStore(spark, str(tmp_path / "s"))

    def load(label):
        return transactions.apply(transactions.extract_transactions(raw), cards, budgets, transactions.no_rates(spark),
                                  label, store, datetime(2024, 1, 2))

    assert load("one") == 1 and load("two") == 1
    assert store.read("transactions").select("transaction_id", F.col("amount_usd").cast("string")).first() == ("t", "1.00")
