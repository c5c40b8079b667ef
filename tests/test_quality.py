from pyspark.sql import functions as F

from tidemark.operators import links as L
from tidemark.operators import quality as Q
from tidemark.plans.groups import clean_groups


def test_groups_only_the_good_one_stays(spark, rows):
    raw = rows("id string, name string, parent_group_id string, agent_ids array<string>",
               ("1", "good", None, ["5"]), (None, "no id", None, []), ("3", None, "1", []), ("4", "loop", "4", []),
               ("x5", "", None, None))
    tagged = clean_groups(raw)
    assert [(r.group_id, r.user_ids) for r in Q.good_rows(tagged).collect()] == [(1, [5])]
    bad = {r.raw_id: r.reasons for r in Q.bad_rows(tagged).collect()}
    assert bad == {None: ["bad_key"], "3": ["missing_group_name"], "4": ["self_parent"],
                   "x5": ["bad_key", "missing_group_name"]}


def test_undecidable_rule_is_a_fault_and_nothing_is_lost(spark, rows):
    df = rows("v int", (1,), (-1,), (None,))
    good, bad = Q.validate(df, [Q.Rule("negative", F.col("v") < 0)])
    assert [r.v for r in good.collect()] == [1]
    assert {r.v for r in bad.collect()} == {-1, None}
    metrics = Q.stage_metrics(Q.tag_faults(df, [Q.Rule("negative", F.col("v") < 0)]), "s").first()
    assert tuple(metrics) == ("s", 3, 1, 2)


def test_allow_list_is_case_sensitive_and_quotes_are_safe(spark, rows):
    df = rows("code string", ("USD",), ("usd",), (None,), ("O'K",), ("a\\b",))
    good, _ = Q.validate(df, [Q.not_listed("code", ["USD", "O'K", "a\\b"])])
    assert {r.code for r in good.collect()} == {"USD", "O'K", "a\\b"}


def test_quarantine_record_carries_the_row(spark, rows):
    _, bad = Q.validate(rows("v int", (None,)), [Q.missing("v", F.col("v").cast("string"))])
    record = Q.quarantine_record(bad, "things").first()
    assert (record.source_entity, record.reasons) == ("things", ["missing_v"])


def test_orphans_and_duplicates(spark, rows):
    links = rows("g int, u int", (1, 1), (1, 2), (2, None))
    lost = Q.orphans(links, rows("id int", (1,), (1,)), {"u": "id"})
    assert {tuple(r) for r in lost.select("g", "u").collect()} == {(1, 2), (2, None)}
    assert [tuple(r) for r in Q.duplicate_keys(links, ["g"]).collect()] == [(1, 2)]


def test_role_names(spark, rows):
    named = rows("user_id bigint, role_id string, role_name string, role_desc string",
                 (1, "r1", "Admin", "d"), (1, "r1", "Admin", "d"), (2, "r2", "12345", "d"), (3, "r3", None, None),
                 (4, None, None, None))
    assert {r.role_id for r in L.distinct_links(named).collect()} == {"r1", "r3"}
    assert {r.role_id for r in L.distinct_links(named, keep_unnamed=False).collect()} == {"r1"}
    assert {r.role_id for r in L.distinct_roles(named, keep_unnamed=False).collect()} == {"r1"}


def test_members(spark, rows):
    groups = rows("group_id bigint, user_ids array<bigint>", (1, [7, 7, 8, None]), (2, []), (3, None))
    members = L.explode_members(groups)
    assert sorted(tuple(r) for r in members.collect()) == [(1, 7), (1, 8)]
    named = L.member_status(members, rows("user_id bigint, status string", (7, "active")))
    assert {tuple(r) for r in named.collect()} == {(1, 7, "active"), (1, 8, "inactive")}
    assert [tuple(r) for r in L.direct_activity(named).collect()] == [(1, 1)]


def test_explode_roles_keeps_users_without(spark, rows):
    users = rows("user_id int, role_ids array<string>", (1, ["a", "b"]), (2, []), (3, None))
    assert {tuple(r) for r in L.explode_roles(users).collect()} == {(1, "a"), (1, "b"), (2, None), (3, None)}
