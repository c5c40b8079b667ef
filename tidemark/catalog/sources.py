"""Envelopes, unions and snapshot choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.registry import Tables, query
from tidemark.plans import users
from tidemark.schemas import CORRUPT, RAW, empty
from tidemark.sources import snapshots as S
from tidemark.streaming.incremental import incremental_batch, ledger_entries, unprocessed


@query("SELECT conv_id, turn, role, text FROM conversations")
def unwrap_results(t: Tables) -> DataFrame:
    """Turns sent as JSON pages ``{"results": [...]}``, parsed and promoted to rows; texts are carried whole."""
    record = F.struct("conv_id", "turn", "role", "text")
    pages = t.conversations.select(F.to_json(F.struct(F.array(record).alias("results"))).alias("body"))
    schema = "results ARRAY<STRUCT<conv_id: BIGINT, turn: BIGINT, role: STRING, text: STRING>>"
    return S.unwrap_results(pages.select(F.from_json("body", schema).alias("page")).select("page.*"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def wrap_row_struct(t: Tables) -> DataFrame:
    return S.wrap_row(t.conversations).select("t.conv_id", "t.turn", "t.role", "t.text")


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_by_name_fill(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return S.union_fill([customers, suppliers])


@query("""SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def snapshot_select(t: Tables) -> DataFrame:
    days = t.events.select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    return S.select_day(days, "2024-01-15")


@query("""SELECT user_id, event_type, event_id, ts, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
    FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00') WHERE rn = 1""")
def watermark_incremental(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    mark = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return incremental_batch(events, "ts", mark, ["user_id", "event_type"])


@query("""SELECT event_id, user_id, 'day=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS source_path FROM events
WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE ts < TIMESTAMP '2024-01-12 06:00:00')""")
def ledger_incremental(t: Tables) -> DataFrame:
    """Rows of files an earlier run has not listed; a day stands for a file."""
    path = F.concat(F.lit("day="), F.to_date("ts").cast("string"))
    events = t.events.select("event_id", "user_id", "ts", path.alias("source_path"))
    ledger = ledger_entries(events.filter("ts < timestamp_ntz'2024-01-12 06:00:00'"), "first")
    return unprocessed(events, ledger).select("event_id", "user_id", "source_path")


_HEADERS = {"BUILDING": "id,name,description", "MACHINERY": "description,id", "": "name,extra,id"}


@query("""SELECT CASE WHEN c_acctbal > 9000 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id,
       CASE WHEN c_acctbal > 9000 OR c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name END AS name,
       CASE WHEN c_acctbal > 9000 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN NULL ELSE 'in ' || c_nationkey || ', ' || c_mktsegment END AS description,
       CASE WHEN c_acctbal > 9000 THEN c_custkey || ',' || c_name || ',x,y' END AS unreadable FROM customer""")
def csv_rows_parse(t: Tables) -> DataFrame:
    """CSV lines under three headers, as files of one folder have them; lines with too many cells keep their text."""
    about = F.concat(F.lit("in "), F.col("c_nationkey").cast("string"), F.lit(", "), "c_mktsegment")
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    header = F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).otherwise("")
    cells = F.when(F.col("c_acctbal") > 9000, F.concat_ws(",", key, name, F.lit("x"), F.lit("y")))
    cells = cells.when(header == "BUILDING", F.to_csv(F.struct(key.alias("a"), name.alias("b"), about.alias("c"))))
    cells = cells.when(header == "MACHINERY", F.to_csv(F.struct(about.alias("a"), key.alias("b"))))
    cells = cells.otherwise(F.to_csv(F.struct(name.alias("a"), F.lit("-").alias("b"), key.alias("c"))))
    names = F.create_map(*[F.lit(x) for pair in _HEADERS.items() for x in pair])
    found = S.csv_lines(t.customer.select(names[header].alias("header"), cells.alias("line")), RAW["roles"], list(_HEADERS.values()))
    bad = F.col(CORRUPT).isNotNull()
    return found.select(*[F.when(~bad, F.col(c)).alias(c) for c in ("id", "name", "description")], F.col(CORRUPT).alias("unreadable"))


@query("""SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN o_orderkey ELSE 2 * o_orderkey END AS user_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN c_name WHEN 'MACHINERY' THEN 'Ann ' || c_custkey WHEN 'FURNITURE' THEN 'Bo'
           WHEN 'AUTOMOBILE' THEN 'of contact' END AS user_name,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'c@example.org' ELSE 'no-email@placeholder.com' END AS user_email,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'missing_user_name' ELSE '' END AS reasons
FROM customer JOIN orders ON c_custkey = o_custkey""")
def user_index_layouts(t: Tables) -> DataFrame:
    """Index records as JSON text in five layouts, through the record step, the choice of sources and the rules of a run.

    Names stand in the record, in two parts, in one part, in the contact, or nowhere; some records come in pages.
    """
    k = F.when(F.col("c_mktsegment") == "BUILDING", F.col("o_orderkey")).otherwise(2 * F.col("o_orderkey"))
    both = F.struct(F.lit("of contact").alias("name"), F.lit("c@example.org").alias("email"))
    email = F.struct(F.lit("c@example.org").alias("email"))
    named, parts, one, apart, none = (
        F.to_json(F.struct(k.alias("id"), *fields)) for fields in (
            (F.col("c_name").alias("name"), email.alias("contact")),
            (F.lit("Ann").alias("first_name"), F.col("c_custkey").alias("last_name")),
            (F.lit("Bo").alias("first_name"),), (both.alias("contact"),), (F.lit("2021").alias("created_at"),),
        )
    )
    segment = F.col("c_mktsegment")
    record = F.when(segment == "BUILDING", named).when(segment == "MACHINERY", parts).when(segment == "FURNITURE", one)
    record = record.when(segment == "AUTOMOBILE", apart).otherwise(none)
    paged = F.concat(F.lit('{"results": ['), record, F.lit("]}"))
    body = F.when(F.col("o_orderstatus") == "F", paged).otherwise(record)
    raw = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.from_json(body, S.page_schema(RAW["agents"]), {"columnNameOfCorruptRecord": CORRUPT}).alias("page")
    ).select("page.*")
    index, facts = users.with_facts(S.page_records(raw, RAW["agents"], F.lit(None).cast("string")))
    tagged = users.clean_users(users.resolve_users(index, empty(t.spark, RAW["agent_details"]), facts))
    return tagged.select("user_id", "user_name", F.coalesce("user_email", F.lit("")).alias("user_email"), F.array_join("reasons", ",").alias("reasons"))
