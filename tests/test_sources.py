import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.two_days import _payment, _write
from tidemark.operators import quality as Q
from tidemark.plans import transactions
from tidemark.plans.inputs import mistyped_files
from tidemark.plans.transactions import extract_budgets, extract_transactions, survivors
from tidemark.plans.users import PLACEHOLDER_EMAIL, UNKNOWN_NAME, clean_users, resolve_users
from tidemark.schemas import CORRUPT, RAW, TABLES, TableSpec, conform, empty
from tidemark.sources.rates import parse_rate_map, rates_from_documents
from tidemark.sources.snapshots import infer_entity, read_entity, union_fill, unwrap_results, wrap_row
from tidemark.sources.state import StateStore
from tidemark.streaming import incremental as I

NO_DETAILS = RAW["agent_details"]


def test_all_formats_of_a_folder_are_united(spark, tmp_path):
    _write(tmp_path, "d", "roles", "1.json", [{"id": 1, "name": "json"}])
    _write(tmp_path, "d", "roles", "2.json", {"results": [{"id": "2", "name": "page", "extra": 1}]})
    _write(tmp_path, "d", "roles", "3.csv", "name,id\ncsv,3\n")
    spark.createDataFrame([(4, "parquet")], "id bigint, description string").coalesce(1).write.parquet(
        str(tmp_path / "p")
    )
    source = next((tmp_path / "p").glob("part-*.parquet"))
    (tmp_path / "d" / "roles" / "4.parquet").write_bytes(source.read_bytes())
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"])
    found = {(r.id, r.name, r.description, r.source_path.rsplit("/", 1)[-1]) for r in got.collect()}
    assert found == {("1", "json", None, "1.json"), ("2", "page", None, "2.json"), ("3", "csv", None, "3.csv"),
                     ("4", None, "parquet", "4.parquet")}


def test_nested_values_in_csv_and_parquet(spark, tmp_path):
    _write(tmp_path, "d", "agents", "1.csv", 'id,contact\n1,"{\\"name\\": \\"Ada\\", \\"email\\": \\"a@example.org\\"}"\n')
    spark.createDataFrame([(2, ("Bo",))], "id bigint, contact struct<name: string>").coalesce(1).write.parquet(str(tmp_path / "p"))
    source = next((tmp_path / "p").glob("part-*.parquet"))
    (tmp_path / "d" / "agents" / "2.parquet").write_bytes(source.read_bytes())
    got = read_entity(spark, str(tmp_path), "d", "agents", RAW["agents"])
    assert {(r.id, r.contact.name, r.contact.email) for r in got.collect()} == {
        ("1", "Ada", "a@example.org"), ("2", "Bo", None)
    }


def test_absent_and_empty_folders_are_empty_frames(spark, tmp_path):
    (tmp_path / "d" / "roles").mkdir(parents=True)
    for day in ("d", "never"):
        got = read_entity(spark, str(tmp_path), day, "roles", RAW["roles"])
        assert got.isEmpty() and "source_path" in got.columns
        assert infer_entity(spark, str(tmp_path), day, "roles") is None


def test_truncated_json_goes_to_quarantine(spark, tmp_path):
    _write(tmp_path, "d", "agents", "1.json", '[{"id": 1, "contact": {"na')
    _write(tmp_path, "d", "agents", "2.json", [{"id": 2, "contact": {"name": "Bo", "email": "b@example.org"}}])
    index = read_entity(spark, str(tmp_path), "d", "agents", RAW["agents"])
    tagged = clean_users(resolve_users(index, empty(spark, NO_DETAILS))).cache()
    assert [r.user_id for r in Q.good_rows(tagged).collect()] == [2]
    bad = Q.bad_rows(tagged).collect()
    assert len(bad) == 1 and "corrupt_record" in bad[0].reasons and bad[0][CORRUPT].startswith("[{")


def test_one_mistyped_record_does_not_cost_the_others(spark, tmp_path):
    good = [{"id": n, "contact": {"name": f"n{n}", "email": f"n{n}@example.org"}} for n in range(3)]
    _write(tmp_path, "d", "agents", "1.json", [*good, {"id": 9, "contact": "none"}])
    index = read_entity(spark, str(tmp_path), "d", "agents", RAW["agents"])
    tagged = clean_users(resolve_users(index, empty(spark, NO_DETAILS)))
    assert {(r.user_id, r.user_name) for r in Q.good_rows(tagged).collect()} == {
        (0, "n0"), (1, "n1"), (2, "n2"), (9, UNKNOWN_NAME)
    }
    lines = mistyped_files(tagged, "agents").collect()
    assert [r.reasons for r in lines] == [["mistyped_field"]] and "1.json" in lines[0].record


def test_json_lines(spark, tmp_path):
    _write(tmp_path, "d", "roles", "1.json", '{"id": 1}\n{"results": [{"id": 2}, {"id": 3}]}\n')
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"], multiline=False)
    assert {r.id for r in got.collect()} == {"1", "2", "3"}


def test_inferred_layout(spark, tmp_path):
    _write(tmp_path, "d", "agents", "1.json", {"results": [{"id": 1, "first_name": "Ada", "last_name": "L"}]})
    got = infer_entity(spark, str(tmp_path), "d", "agents")
    user = resolve_users(got, empty(spark, NO_DETAILS)).first()
    assert (user.user_name, user.user_email) == ("Ada L", PLACEHOLDER_EMAIL)


def test_user_fallbacks(spark, rows):
    none = empty(spark, NO_DETAILS)
    named = resolve_users(rows("id bigint, name string", (1, "only")), none).first()
    assert (named.user_name, named.user_email, named.created_at, named.role_ids) == ("only", PLACEHOLDER_EMAIL, None, None)
    assert resolve_users(rows("id bigint", (1,)), none).first().user_name == UNKNOWN_NAME
    # An index that has names but lacks this one: no name is invented, the row goes to quarantine.
    nameless = clean_users(resolve_users(rows("id bigint, name string", (1, None)), none)).first()
    assert nameless.reasons == ["missing_user_name"]
    details = rows("id bigint, contact struct<name: string, email: string>, role_ids array<string>",
                   (1, ("Det", "d@example.org"), ["r1"]))
    full = resolve_users(rows("id bigint, name string", (1, "idx"), (2, "two")), details)
    assert {(r.raw_id, r.user_name, r.user_email) for r in full.collect()} == {
        ("1", "Det", "d@example.org"), ("2", "two", PLACEHOLDER_EMAIL)
    }


def test_bad_date_keeps_the_user(spark, rows):
    index = rows("id bigint, name string, created_at string", (1, "a", "2022-05-"))
    user = Q.good_rows(clean_users(resolve_users(index, empty(spark, NO_DETAILS)))).first()
    assert (user.user_id, user.created_at) == (1, None)


def test_minimal_transactions(spark, rows):
    raw = rows("id string, currencyData struct<originalCurrencyAmount: string, exponent: bigint, originalCurrencyCode: string>",
               ("t", ("12559", 2, "USD")))
    flat = extract_transactions(raw).first()
    assert (flat.transaction_id, str(flat.original_amount), flat.card_id, flat.transaction_date) == ("t", "125.59", None, None)
    assert extract_budgets(rows("id string, name string", ("b", "n"))).first().budget_description is None


def test_duplicate_transactions_latest_survives_and_rows_without_id_stay(spark, rows):
    flat = rows("transaction_id string, updated_time string, v int", ("a", "1", 1), ("a", "2", 2), (None, "1", 3), (None, "1", 3))
    assert sorted((r.v for r in survivors(flat).collect())) == [2, 3, 3]


def test_unwrap_wrap_and_union(spark, rows):
    page = rows("results array<struct<id: int>>", ([(1,), (2,)],), ([],), (None,))
    assert [r.id for r in unwrap_results(page).collect()] == [1, 2]
    bare = rows("id int", (1,))
    assert unwrap_results(bare) is bare
    assert wrap_row(bare).select("t.id").first().id == 1
    assert [tuple(r) for r in union_fill([bare, rows("b int, id int", (9, 2))]).collect()] == [(1, None), (2, 9)]


def test_conform_drops_adds_and_retypes(spark, rows):
    got = conform(rows("user_id string, extra int", ("7", 1), ("x", 2)), TABLES["users"].schema)
    assert got.columns == TABLES["users"].columns and [r.user_id for r in got.collect()] == [7, None]


def test_rates(spark, rows):
    docs = rows("date string, body string", ("2026-01-05", json.dumps({"usd": {"gbp": 0.79, "eur": 0, "inr": None, "xyz": 3, "usd": 5}})),
                ("2026-01-06", "not json"), ("soon", "{}"))
    got = rates_from_documents(docs.select("date", parse_rate_map(F.col("body")).alias("usd")))
    assert {(r.currency, str(r.rate_date), r.rate) for r in got.collect()} == {
        ("GBP", "2026-01-05", 1 / 0.79), ("USD", "2026-01-05", 1.0), ("USD", "2026-01-06", 1.0)
    }


def test_state_gets_new_columns_and_pins_its_version(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.commit({"roles": spark.createDataFrame([("r", "n", "d")], TABLES["roles"].schema)})
    pinned = store.read("roles")
    kind = T.StructType([*TABLES["roles"].schema.fields, T.StructField("kind", T.StringType())])
    wider = StateStore(spark, store.root, {**TABLES, "roles": TableSpec(kind, ("role_id",))})
    assert tuple(wider.read("roles").first()) == ("r", "n", "d", None)
    store.commit({"roles": store.read("roles").withColumn("role_name", F.lit("m"))}, laid_out={"roles"})
    assert pinned.first().role_name == "n" and store.read("roles").first().role_name == "m"
    assert store.version == 2 and StateStore(spark, store.root).version == 2


def test_marks_and_ledger(spark, rows):
    df = rows("k int, at timestamp, source_path string", (1, datetime(2024, 1, 1), "a"), (1, datetime(2024, 1, 3), "b"),
              (2, datetime(2024, 1, 2), "b"))
    assert {(r.k, r.source_path) for r in I.incremental_batch(df, "at", datetime(2024, 1, 1), ["k"]).collect()} == {(1, "b"), (2, "b")}
    assert I.incremental_batch(df, "at", None, ["k"]).count() == 2
    assert I.next_mark(df, "at").first().mark == datetime(2024, 1, 3)
    ledger = I.ledger_entries(df.filter("source_path = 'a'"), "run1")
    assert {r.source_path for r in I.unprocessed(df, ledger).collect()} == {"b"}


def test_the_mark_reaches_the_scan(spark, rows, tmp_path):
    rows("at timestamp", (datetime(2024, 1, 1),)).write.parquet(str(tmp_path / "t"))
    marked = I.above_mark(spark.read.parquet(str(tmp_path / "t")), "at", datetime(2024, 1, 1))
    assert "GreaterThan(at" in marked._jdf.queryExecution().executedPlan().toString()


def test_stream_takes_each_page_once(spark, tmp_path):
    cards = spark.createDataFrame([("c1", "card", "1", "V", "ok")], TABLES["cards"].schema)
    budgets = spark.createDataFrame([("b1", "budget", None)], TABLES["budgets"].schema)
    store = StateStore(spark, str(tmp_path / "state"))
    folder, marks = tmp_path / "in" / "x" / "transactions", str(tmp_path / "marks")

    def run():
        I.stream_transactions(spark, str(folder), cards, budgets, transactions.no_rates(spark), store, marks, datetime(2026, 1, 1))
        return {r.transaction_id: str(r.original_amount) for r in store.read("transactions").collect()}

    _write(tmp_path / "in", "x", "transactions", "1.json", {"results": [_payment("t1", "100", 2, "USD", "c1", "b1")]})
    assert run() == {"t1": "1.00"}
    _write(tmp_path / "in", "x", "transactions", "2.json", [_payment("t2", "200", 2, "USD", "c1", "b1"), _payment("t1", "150", 2, "USD", "c1", "b1")])
    assert run() == {"t1": "1.50", "t2": "2.00"}
    version = store.version
    assert run() == {"t1": "1.50", "t2": "2.00"} and store.version == version
    assert store.read("transaction_cards").count() == 2


def test_late_repeats_are_dropped_in_a_stream(spark, tmp_path):
    for n in (1, 2):
        _write(tmp_path, "x", "transactions", f"{n}.json", [_payment("t1", "100", 2, "USD", "c1", "b1")])
    flat = I.drop_late_repeats(extract_transactions(I.transaction_pages(spark, str(tmp_path / "x" / "transactions"))))
    query = flat.writeStream.format("memory").queryName("repeats").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("repeats").count() == 1


def test_old_versions_are_listed_for_removal(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    for name in ("a", "b", "c"):
        store.commit({"roles": spark.createDataFrame([("r", name, "d")], TABLES["roles"].schema)})
    assert store.superseded(keep=1).count() == 2 and store.superseded(keep=3).count() == 0
