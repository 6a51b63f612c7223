import random
from collections import Counter, deque

import pytest

from batchkit.operators import graph
from batchkit.operators.staging import Stage


def make(spark, vertices, edges):
    return graph.build(
        spark.createDataFrame([(v, f"name {v}") for v in vertices], "id string, name string"),
        spark.createDataFrame(edges, "src string, dst string"),
    )


def random_graph(seed, crowded=False):
    rng = random.Random(seed)
    vertices = [f"v{i:02d}" for i in range(25)]
    known = vertices + ["gone"]
    edges = [(rng.choice(known), rng.choice(known)) for _ in range(40)]
    if crowded:  # one vertex is an end of a third of the edges
        edges += [(rng.choice(vertices), "v03") for _ in range(15)]
        edges += [("v03", rng.choice(vertices)) for _ in range(15)]
    edges += edges[:5] + [("v01", None), (None, "v02"), ("v03", "v03")]
    return vertices, edges


def usable(vertices, edges):
    return [(s, d) for s, d in edges if s in vertices and d in vertices]


def brute_motif(vertices, edges, anchor, hops, distinct):
    into = Counter(usable(vertices, edges))
    paths = {(anchor,): 1}
    for _ in range(hops):
        longer = Counter()
        for path, ways in paths.items():
            for (s, d), n in into.items():
                if d == path[-1] and not (distinct and s in path):
                    longer[path + (s,)] += ways * n
        paths = longer
    return paths


def brute_distances(vertices, edges, landmark):
    into = {}
    for s, d in usable(vertices, edges):
        into.setdefault(d, set()).add(s)
    hops, queue = {landmark: 0}, deque([landmark])
    while queue:
        v = queue.popleft()
        for s in into.get(v, ()):
            if s not in hops:
                hops[s] = hops[v] + 1
                queue.append(s)
    return hops


def brute_components(vertices, edges):
    label = {v: v for v in vertices}
    changed = True
    while changed:
        changed = False
        for s, d in usable(vertices, edges):
            low = min(label[s], label[d])
            if label[s] != low or label[d] != low:
                label[s] = label[d] = low
                changed = True
    return label


def test_build_keeps_multiplicity_and_drops_null_ends(spark, rows):
    g = graph.build(
        spark.createDataFrame([(1, "x")], "airport int, name string"),
        spark.createDataFrame(
            [(1, 2, "a"), (1, 2, "b"), (1, 1, "c"), (None, 2, "d"), (1, None, "e")],
            "f int, t int, airline string",
        ),
        "airport",
        "f",
        "t",
    )
    assert rows(g.edges) == [("1", "1", "c"), ("1", "2", "a"), ("1", "2", "b")]
    assert dict(rows(graph.in_degrees(g))) == {"1": 1, "2": 2}


def test_top_in_degree_breaks_ties_by_id_and_stays_sorted(spark):
    g = make(spark, "abcd", [("a", "c"), ("a", "b"), ("b", "d"), ("c", "d"), ("a", "d")])
    got = [tuple(r) for r in graph.top_in_degree(g, 2).collect()]
    assert got == [("d", 3, "name d"), ("b", 1, "name b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_motifs_against_brute_force(spark, seed):
    vertices, edges = random_graph(seed, crowded=True)
    g = make(spark, vertices, edges)
    routes = graph.merge_routes(g)
    for hops, distinct in [(1, False), (1, True), (2, False), (2, True), (3, True), (4, True)]:
        want = brute_motif(vertices, edges, "v03", hops, distinct)
        count = graph.count_motif(g, "v03", hops, distinct, routes).first().matches
        assert count == sum(want.values()), (hops, distinct)
        if hops in (2, 3):
            found = graph.find_motif(g, "v03", hops, distinct, routes).collect()
            assert {("v03", *r[:-1]): r[-1] for r in found} == want


def test_self_loop_counts_at_one_hop_only(spark):
    g = make(spark, "ab", [("a", "a"), ("b", "a"), ("b", "a"), ("gone", "a")])
    assert graph.count_motif(g, "a", 1).first().matches == 3
    assert graph.count_motif(g, "a", 2, distinct=True).first().matches == 0
    assert graph.count_motif(g, "gone", 1).first().matches == 0
    with pytest.raises(ValueError):
        graph.find_motif(g, "a", 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_distances_against_brute_force(spark, seed):
    vertices, edges = random_graph(seed, crowded=True)
    got = graph.distances_to(make(spark, vertices, edges), ["v03", "v07"]).collect()
    for landmark in ("v03", "v07"):
        want = brute_distances(vertices, edges, landmark)
        assert {r.id: r.hop for r in got if r.landmark == landmark} == want
    assert len(got) == len({(r.id, r.landmark) for r in got})


def test_many_landmarks_join_each_edge_once_a_round(spark):
    rng = random.Random(4)
    vertices = [f"v{i:03d}" for i in range(130)]
    edges = [(rng.choice(vertices), rng.choice(vertices)) for _ in range(400)]
    g = make(spark, vertices, edges)
    routes = graph.merge_routes(g)
    landmarks = vertices[:100] + ["gone", vertices[3]]
    got = graph.distances_to(g, landmarks, routes).collect()
    for landmark in vertices[:100]:
        want = brute_distances(vertices, edges, landmark)
        assert {r.id: r.hop for r in got if r.landmark == landmark} == want
    assert len(got) == len({(r.id, r.landmark) for r in got})
    # written: a row for a vertex and round, not one for a vertex and landmark
    newest = graph.distances_to(g, landmarks, routes)
    folder = newest.inputFiles()[0].split("/hop=")[0]
    stored = spark.read.parquet(folder)
    assert stored.groupBy("id", "hop").count().filter("count > 1").isEmpty()
    assert stored.count() * 5 < len(got)
    assert graph.distances_to(g, [], routes).collect() == []


def test_a_long_path(spark, rows):
    names = [f"n{i:02d}" for i in range(12)]
    g = make(spark, names, list(zip(names, names[1:])))
    distances = graph.distances_to(g, [names[-1]])
    assert dict((r.id, r.hop) for r in distances.collect()) == {
        n: 11 - i for i, n in enumerate(names)
    }
    assert rows(graph.farthest(g, names[-1])) == [("n00", 11, "name n00")]
    assert {r.component for r in graph.connected_components(g).collect()} == {"n00"}


def test_distance_map(spark):
    g = make(spark, "abc", [("a", "b"), ("b", "c")])
    maps = graph.distance_map(graph.distances_to(g, ["b", "c"]))
    got = {r.id: (r.b, r.c) for r in maps.selectExpr("id", "distances['b'] b", "distances['c'] c").collect()}
    assert got == {"a": (1, 2), "b": (0, 1), "c": (None, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_against_brute_force(spark, seed):
    vertices, edges = random_graph(seed, crowded=seed == 2)
    edges = edges if seed == 2 else edges[::2]
    got = graph.connected_components(make(spark, vertices, edges)).collect()
    assert {r.id: r.component for r in got} == brute_components(vertices, edges)
    assert len(got) == len(vertices)


def written(monkeypatch, g):
    """The components, and the rows written in the rounds after the peeling."""
    count, put = [], Stage.put

    def watched(self, df, name):
        table = put(self, df, name)
        if name.split("-")[0] in ("below", "large", "lowest"):
            count.append(table.count())
        return table

    monkeypatch.setattr(Stage, "put", watched)
    return {r.id: r.component for r in graph.connected_components(g).collect()}, sum(count)


def test_peeling_a_star_and_pairs(spark, monkeypatch):
    star = [("m", f"{'a' if i else 'z'}{i:02d}") for i in range(40)]
    pairs = [(f"p{i}", f"q{i}") for i in range(10)]
    vertices = sorted({v for e in star + pairs for v in e} | {"alone"})
    got, rows_written = written(monkeypatch, make(spark, vertices, star + pairs))
    assert got == brute_components(vertices, star + pairs)
    assert {got[v] for e in star for v in e} == {"a01"} and rows_written == 0


def test_peeling_a_path_and_leaves_with_small_ids(spark, monkeypatch):
    path = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(12)]
    leaves = [(f"a{i:02d}", f"n{i:02d}") for i in range(1, 12)] + [("b", "n05"), ("n05", "c")]
    vertices = sorted({v for e in path + leaves for v in e})
    got, with_leaves = written(monkeypatch, make(spark, vertices, path + leaves))
    assert set(got.values()) == {"a01"} and len(got) == len(vertices)
    _, alone = written(monkeypatch, make(spark, vertices, path[1:-1]))
    assert 0 < with_leaves < 2 * alone


def test_component_sizes(spark, rows):
    g = make(spark, "abcdef", [("a", "b"), ("c", "b"), ("d", "e"), ("f", "f")])
    components = graph.connected_components(g)
    assert rows(graph.component_sizes(components)) == [("a", 3), ("d", 2)]
    assert rows(graph.component_sizes(components, 1)) == [("a", 3), ("d", 2), ("f", 1)]


def test_graph_without_edges(spark, rows):
    g = make(spark, "ab", [])
    assert rows(graph.connected_components(g)) == [("a", "a"), ("b", "b")]
    assert rows(graph.distances_to(g, ["a"])) == [("a", "a", 0)]
    assert graph.count_motif(g, "a", 3, distinct=True).first().matches == 0
    assert rows(graph.top_in_degree(g)) == []
