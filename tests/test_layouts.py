"""Runs read every record layout: names at the top level or in parts, members as lists of objects or ids."""

import json

from tidemark.plans import groups, users
from tidemark.sources.state import StateStore


def _dump(root, day, entity, records):
    folder = root / day / entity
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(json.dumps({"results": records}))


def test_user_index_layouts(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"), buckets=2)
    _dump(tmp_path, "d1", "agents", [{"id": 1, "name": "Ann", "email": "a@x.org"}, {"id": 2, "name": None, "email": "b@x.org"}])
    users.run(spark, str(tmp_path), "d1", store)
    assert {(r.user_id, r.user_name, r.user_email) for r in store.read("users").collect()} == {(1, "Ann", "a@x.org")}
    _dump(tmp_path, "d2", "agents", [{"id": 3, "first_name": "Bo", "last_name": "Li", "email": "c@x.org"}])
    users.run(spark, str(tmp_path), "d2", store)
    assert {r.user_name for r in store.read("users").filter("user_id = 3").collect()} == {"Bo Li"}


def test_group_member_layouts(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"), buckets=2)
    _dump(tmp_path, "d1", "agents", [{"id": k, "name": f"n{k}", "email": "e"} for k in (1, 2, 3)])
    users.run(spark, str(tmp_path), "d1", store)
    _dump(tmp_path, "d1", "admin_groups", [
        {"id": 10, "name": "a", "users": [{"id": 1}, {"id": 2}]}, {"id": 11, "name": "b", "members": {"id": [3]}},
        {"id": 12, "name": "c", "agent_ids": [2]}, {"id": 13, "name": "d"},
    ])
    groups.run(spark, str(tmp_path), "d1", store)
    links = {(r.group_id, r.user_id) for r in store.read("group_members").collect()}
    assert links == {(10, 1), (10, 2), (11, 3), (12, 2)}
    _dump(tmp_path, "d2", "admin_groups", [{"id": 10, "name": "a", "users": "gone"}])
    groups.run(spark, str(tmp_path), "d2", store)
    links = {(r.group_id, r.user_id) for r in store.read("group_members").collect() if r.group_id == 10}
    assert links == {(10, 1), (10, 2)}
    assert "bad_members" in str(store.records("quarantine").collect())


def test_each_record_has_its_own_source_of_a_name(spark, tmp_path):
    """One record with a name at the top level does not cost those that are named in their contact."""
    store = StateStore(spark, str(tmp_path / "state"), buckets=2)
    apart = [{"id": k, "contact": {"name": f"n{k}", "email": f"n{k}@x.org"}} for k in range(1, 6)]
    _dump(tmp_path, "d1", "agents", apart)
    users.run(spark, str(tmp_path), "d1", store)
    _dump(tmp_path, "d2", "agents", [
        *apart, {"id": 6, "name": "Zed", "email": "z@x.org"}, {"id": 7, "first_name": "Bo", "email": "b@x.org"}, {"id": 8, "email": "nameless@x.org"},
        {"id": 9, "name": "own", "contact": {"name": "other", "email": "c@x.org"}},
    ])
    users.run(spark, str(tmp_path), "d2", store)
    found = {r.user_id: (r.user_name, r.user_email, r.status) for r in store.read("users").collect()}
    assert found == {k: (f"n{k}", f"n{k}@x.org", "active") for k in range(1, 6)} | {
        6: ("Zed", "z@x.org", "active"), 7: ("Bo", "b@x.org", "active"), 9: ("own", "c@x.org", "active")
    }
    _dump(tmp_path, "d3", "agents", [{"id": 1, "contact": {"email": "a@x.org"}}, {"id": 2}])
    users.run(spark, str(tmp_path), "d3", store)
    found = {r.user_id: (r.user_name, r.user_email) for r in store.read("users").filter("status = 'active'").collect()}
    assert found == {1: ("Unknown Name", "a@x.org"), 2: ("Unknown Name", "no-email@placeholder.com")}
