import random

import pytest

from tidemark.operators import hierarchy as H


def brute(parent, seeds):
    live, cyclic, related = set(), set(), {}
    for node in seeds:
        while node is not None and node not in live:
            live.add(node)
            node = parent.get(node)
    for node in parent:
        above, depth = parent.get(node), 1
        while above is not None and (node, above) not in related:
            related[node, above] = depth
            if above == node:
                cyclic.add(node)
            above, depth = parent.get(above), depth + 1
    return live, cyclic, related


def frames(spark, parent, seeds):
    edges = spark.createDataFrame(list(parent.items()), "child bigint, parent bigint").coalesce(2)
    return edges, spark.createDataFrame([(s,) for s in seeds], "node bigint").coalesce(1)


def random_forest(seed):
    chance = random.Random(seed)
    parent = {n: chance.randrange(25) for n in range(25) if chance.random() < 0.9}
    return {n: p for n, p in parent.items() if n != p}, chance.sample(range(25), 3)


LOOPS = {1: 2, 2: 1, 3: 4, 4: 5, 5: 6, 6: 7, 7: 3, 8: 3, 9: 8, 10: 11}


@pytest.mark.parametrize("parent, seeds", [random_forest(3), (LOOPS, [9, 10])])
def test_all_loops_agree_with_brute_force(spark, parent, seeds):
    edges, starts = frames(spark, parent, seeds)
    live, cyclic, related = brute(parent, seeds)
    for method in ("auto", "frontier", "doubling"):
        assert {r.node for r in H.propagate_up(edges, starts, method).collect()} == live
    assert {r.node for r in H.find_cycles(edges).collect()} == cyclic
    rows = H.closure(edges, with_path=True).collect()
    assert {(r.node, r.ancestor): r.depth for r in rows} == related and len(rows) == len(related)
    assert {r.node for r in rows if r.in_cycle} == cyclic
    for row in rows:
        assert [row.path[0], row.path[-1], len(row.path)] == [row.node, row.ancestor, row.depth + 1]
        assert all(parent[a] == b for a, b in zip(row.path, row.path[1:]))
    below = {(r.node, r.start): r.depth for r in H.descendants(edges, starts).collect()}
    assert below == {pair: d for pair, d in related.items() if pair[1] in seeds and pair[0] != pair[1]}


def test_chain_deeper_than_a_recursive_query_allows(spark):
    parent = {n: n - 1 for n in range(1, 201)}
    edges, starts = frames(spark, parent, [200])
    assert H.propagate_up(edges, starts).count() == 201


def test_a_self_loop_is_no_edge_and_reported_as_cycle_when_kept(spark, rows):
    nodes = rows("id bigint, parent bigint", (1, 1), (2, 1), (3, None))
    assert [tuple(r) for r in H.forest_edges(nodes, "id", "parent").collect()] == [(2, 1)]
    raw = nodes.selectExpr("id as child", "parent")
    assert [r.node for r in H.find_cycles(raw).collect()] == [1]


def test_activity_reaches_every_ancestor(spark, rows):
    groups = rows("group_id bigint, parent_group_id bigint", (1, None), (2, 1), (3, 2), (4, 1))
    direct = rows("group_id bigint, has_active_member boolean", (3, True), (4, False))
    status = {r.group_id: r.status for r in H.group_activity(groups, direct).collect()}
    assert status == {1: "active", 2: "active", 3: "active", 4: "inactive"}


def test_unknown_method_is_refused(spark, rows):
    with pytest.raises(ValueError):
        H.propagate_up(rows("child int, parent int"), rows("node int"), "guess")


def test_empty_forest(spark, rows):
    edges, none = rows("child bigint, parent bigint"), rows("node bigint")
    assert H.propagate_up(edges, none).isEmpty()
    assert H.find_cycles(edges).isEmpty() and H.closure(edges).isEmpty()
    assert H.descendants(edges, none).isEmpty()


def test_descendants_of_a_deep_chain_take_few_rounds(spark, monkeypatch):
    parent = {n: n - 1 for n in range(1, 3001)} | {5000 + n: n for n in range(0, 3000, 7)}
    edges, starts = frames(spark, parent, [0, 10, 2900, 5007])
    tables = []
    written = H.measured
    monkeypatch.setattr(H, "measured", lambda df, label, **figures: tables.append(label) or written(df, label, **figures))
    found = {(r.start, r.node): r.depth for r in H.descendants(edges, starts).collect()}
    below = {}
    for node in {*parent, 0}:
        above, depth = parent.get(node), 1
        while above is not None:
            if above in (0, 10, 2900, 5007):
                below[above, node] = depth
            above, depth = parent.get(above), depth + 1
    assert found == below
    # The longest way to an asked node is 2,890 steps.
    assert tables.count("jumps") <= 14


@pytest.mark.parametrize("size", [1, 2, 3, 8, 13, 40])
def test_closure_around_a_cycle_takes_no_more_rows_than_it_gives(spark, monkeypatch, size):
    parent = {n: (n + 1) % size for n in range(size)} | {100: 0, 101: 100, 102: size - 1, 103: 101, 200: 201}
    edges, _ = frames(spark, parent, [])
    rows_made = []
    extend = H._extend
    monkeypatch.setattr(H, "_extend", lambda *x: rows_made.append(1) or extend(*x))
    _, cyclic, related = brute(parent, [])
    rows = H.closure(edges, with_path=True).collect()
    assert {(r.node, r.ancestor): r.depth for r in rows} == related and len(rows) == len(related)
    assert {r.node for r in rows if r.in_cycle} == cyclic == set(range(size))
    for row in rows:
        assert [row.path[0], row.path[-1], len(row.path)] == [row.node, row.ancestor, row.depth + 1]
        assert all(parent[a] == b for a, b in zip(row.path, row.path[1:]))
    # Tails are composed, the cycle's own pairs are not: rounds go with the tail's length.
    assert len(rows_made) <= 6
    places = {r.node: r for r in H.rings(edges.selectExpr("child", "parent", "10L as length")).collect()}
    assert {n: (r.ring, r.size, r.round) for n, r in places.items()} == {n: (0, size, 10 * size) for n in range(size)}
    assert all((places[n].place - places[parent[n]].place) % size == 1 % size and places[n].way == 10 * places[n].place for n in places)


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_descendants_and_closure_of_random_graphs(spark, seed):
    parent, seeds = random_forest(seed)
    edges, starts = frames(spark, parent, seeds)
    related = brute(parent, seeds)[2]
    below = {(r.node, r.start): r.depth for r in H.descendants(edges, starts).collect()}
    assert below == {pair: d for pair, d in related.items() if pair[1] in seeds and pair[0] != pair[1]}
    rows = H.closure(edges).collect()
    assert {(r.node, r.ancestor): r.depth for r in rows} == related and len(rows) == len(related)


def looped_heap(size):
    """A binary heap in which some nodes point at their neighbour: two such neighbours form a cycle."""
    chance = random.Random(5)
    return {n: n ^ 1 if chance.random() < 0.3 else (n - 1) // 2 for n in range(1, size)}


def test_cycles_of_a_bushy_forest_are_sought_among_few_nodes(spark, monkeypatch):
    parent = looped_heap(1200)
    edges, _ = frames(spark, parent, [])
    jumped = []
    written = H.counted

    def counted(df, label="step"):
        table, size = written(df, label)
        jumped.append(size if label == "jumps" else 0)
        return table, size

    monkeypatch.setattr(H, "counted", counted)
    assert {r.node for r in H.find_cycles(edges).collect()} == brute(parent, [])[1]
    assert sum(jumped) < len(parent)


def test_closure_of_chains_that_lead_into_cycles_writes_no_more_pairs_than_it_gives(spark, monkeypatch):
    parent = looped_heap(600)
    edges, _ = frames(spark, parent, [])
    written = []

    class Counted(H.Rounds):
        def add(self, df, **figures):
            written.append(super().add(df, **figures))
            return written[-1]

    monkeypatch.setattr(H, "Rounds", Counted)
    rows = H.closure(edges).collect()
    related = brute(parent, [])[2]
    assert {(r.node, r.ancestor): r.depth for r in rows} == related and len(rows) == len(related)
    assert sum(written) <= len(rows)
