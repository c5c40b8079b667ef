"""Folders whose files differ in layout: no record is lost, and no value lands under another column's name."""

import json

from tests.two_days import _write
from tidemark.schemas import CORRUPT, RAW
from tidemark.sources.snapshots import csv_layout, csv_lines, listing, read_entity


def _parquet(spark, tmp_path, folder, name, ddl, *data):
    spark.createDataFrame(list(data), ddl).coalesce(1).write.parquet(str(tmp_path / f"made-{name}"))
    source = next((tmp_path / f"made-{name}").glob("part-*.parquet"))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.parquet").write_bytes(source.read_bytes())


def _roles(df):
    return {(r.id, r.name, r.description) for r in df.filter(f"{CORRUPT} is null").collect()}


def test_json_lines_beside_documents(spark, tmp_path):
    lines = "\n".join(json.dumps({"id": n, "name": f"line {n}"}) for n in range(50))
    _write(tmp_path, "d", "roles", "a lines.json", "\n" + lines + "\n")
    _write(tmp_path, "d", "roles", "b.json", json.dumps([{"id": 100}, {"id": 101}], indent=2))
    _write(tmp_path, "d", "roles", "c.json", json.dumps({"results": [{"id": 200}, {"id": 201}]}, indent=1))
    _write(tmp_path, "d", "roles", "d[1].json", '{"results": [{"id": 300}]}\n{"id": 301}\n[{"id": 302}, {"id": 303}]\n{"id": 30')
    _write(tmp_path, "d", "roles", "e.json", '{"id": 400}')
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"]).collect()
    assert sorted(int(r.id) for r in got if r.id) == [*range(50), 100, 101, 200, 201, 300, 301, 302, 303, 400]
    assert [r[CORRUPT] for r in got if not r.id] == ['{"id": 30']
    assert all(r.source_path for r in got)


def test_csv_columns_follow_their_own_header(spark, tmp_path):
    _write(tmp_path, "d", "roles", "1.csv", "id,name,description\n1,one,first\n2,two\n3,three,third,more\n")
    _write(tmp_path, "d", "roles", "2.csv", 'description,id\n"a, b",4\n')
    _write(tmp_path, "d", "roles", "3.csv", "﻿name,extra,id,name,\nfive,x,5,again,y\n")
    _write(tmp_path, "d", "roles", "4.csv", "id,name,description\n6,six,\n")
    _write(tmp_path, "d", "roles", "5.csv", "")
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"])
    assert _roles(got) == {("1", "one", "first"), ("4", None, "a, b"), ("5", "five", None), ("6", "six", None)}
    assert {r[CORRUPT] for r in got.filter(f"{CORRUPT} is not null").collect()} == {"2,two", "3,three,third,more"}
    assert csv_layout("a,,a").fieldNames() == ["a", "_c1", "_c2", CORRUPT]


def test_parquet_files_of_several_schemas_and_pages(spark, tmp_path):
    folder = tmp_path / "d" / "roles"
    _parquet(spark, tmp_path, folder, "one", "id string, name string", ("1", "one"))
    _parquet(spark, tmp_path, folder, "two", "id string, description string, extra int", ("2", "second", 1))
    _parquet(spark, tmp_path, folder, "page", "results array<struct<id: string, name: string>>", ([("3", "three"), ("4", None)],), ([],))
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"])
    assert _roles(got) == {("1", "one", None), ("2", None, "second"), ("3", "three", None), ("4", None, None)}
    _parquet(spark, tmp_path, folder, "five [a]", "id bigint, name string", (5, "five"))
    got = read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"])
    assert _roles(got) == {("1", "one", None), ("2", None, "second"), ("3", "three", None), ("4", None, None), ("5", "five", None)}


def test_chosen_files_only(spark, tmp_path):
    _write(tmp_path, "d", "roles", "1.json", '{"id": 1}\n{"id": 2}\n')
    _write(tmp_path, "d", "roles", "2.json", {"id": 3})
    _write(tmp_path, "d", "roles", "3.csv", "id\n4\n")
    _write(tmp_path, "d", "roles", "4.csv", "name,id\nn,5\n")
    known = {r.source_path.rsplit("/", 1)[-1]: r for r in listing(spark, str(tmp_path), "d", "roles").collect()}
    assert set(known) == {"1.json", "2.json", "3.csv", "4.csv"} and known["3.csv"].length == 5
    for names, ids in ((["1.json", "4.csv"], {"1", "2", "5"}), (["2.json"], {"3"}), ([], set())):
        files = [known[n].source_path for n in names]
        assert {r.id for r in read_entity(spark, str(tmp_path), "d", "roles", RAW["roles"], files=files).collect()} == ids
    assert listing(spark, str(tmp_path), "d", "nothing").isEmpty()


def test_csv_lines_at_hand(spark, rows):
    lines = rows("header string, line string", ("id,name", '1,"a, b"'), ("name,id", "c,2"), ("id,name", "3"))
    got = csv_lines(lines, RAW["roles"], ["id,name", "name,id"]).collect()
    assert {(r.id, r.name) for r in got if not r[CORRUPT]} == {("1", "a, b"), ("2", "c")}
    assert [r[CORRUPT] for r in got if r[CORRUPT]] == ["3"]
