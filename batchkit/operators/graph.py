"""Measures of a directed multigraph, built from joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from batchkit.operators import rank
from batchkit.operators.staging import Stage


@dataclass(frozen=True)
class Graph:
    """``vertices`` with string ``id``, ``edges`` with string ``src`` and ``dst``."""

    vertices: DataFrame
    edges: DataFrame


def build(
    vertices: DataFrame, edges: DataFrame, id: str = "id", src: str = "src", dst: str = "dst"
) -> Graph:
    """Cast ids to string and drop edges without both ends; further columns are kept."""
    return Graph(
        vertices.withColumnRenamed(id, "id").withColumn("id", F.col("id").cast("string")),
        edges.withColumnsRenamed({src: "src", dst: "dst"})
        .filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .withColumns({"src": F.col("src").cast("string"), "dst": F.col("dst").cast("string")}),
    )


def in_degrees(g: Graph) -> DataFrame:
    """Incoming edges per vertex, parallel edges counted; vertices without any are absent."""
    return g.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))


def top_in_degree(g: Graph, k: int = 10, attributes: tuple[str, ...] = ("name",)) -> DataFrame:
    """The ``k`` largest in-degrees with attributes of the vertex, largest first."""
    order = [F.desc("in_degree"), F.col("id")]
    best = rank.top_k(in_degrees(g), order, k)
    named = g.vertices.select("id", *attributes).join(best, "id")
    return named.select("id", "in_degree", *attributes).orderBy(*order)


def _ids(g: Graph) -> DataFrame:
    return g.vertices.select("id").filter(F.col("id").isNotNull()).distinct()


@dataclass(frozen=True)
class Routes:
    """Merged edges ``(src, dst, edges)`` between known vertices, as a written table of ``stage``."""

    steps: DataFrame
    stage: Stage


def merge_routes(g: Graph) -> Routes:
    """Merge parallel edges and drop those with an end that is not a vertex.

    Runs jobs at once: the merged edges are written and read by all later joins, so hand the result
    to several measures of the same graph. Both sides of those joins are written tables, with which
    Spark splits the edges of a vertex that has very many.
    """
    with Stage(g.edges.sparkSession) as stage:
        return _merge(g, stage)


def _merge(g: Graph, stage: Stage) -> Routes:
    merged = stage.put(
        g.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("edges")), "merged"
    )
    ids = stage.put(_ids(g), "ids")
    known = merged
    for end in ("src", "dst"):
        known = known.join(ids.toDF(end), end, "left_semi")
    steps = stage.put(known, "routes")
    stage.close("routes")
    return Routes(steps, stage)


def _not_seen(column: str, anchor: str, hop: int) -> Column:
    fresh = F.col(column) != F.lit(anchor)
    for earlier in range(1, hop):
        fresh &= F.col(column) != F.col(f"v{earlier}")
    return fresh


def find_motif(
    g: Graph, anchor: str, hops: int = 1, distinct: bool = False, routes: Routes | None = None
) -> DataFrame:
    """Paths of ``hops`` edges that end in ``anchor``.

    ``v1`` is the vertex one hop before the anchor, ``v2`` the one before that, and so on.
    ``matches`` is the number of ways to choose parallel edges. With ``distinct`` no vertex
    occurs twice. The search starts at the anchor, so each hop extends only what reached it.
    """
    return _paths(routes or merge_routes(g), anchor, hops, distinct)


def _paths(routes: Routes, anchor: str, hops: int, distinct: bool) -> DataFrame:
    if hops < 1:
        raise ValueError("hops must be at least 1")
    paths = routes.steps.filter(F.col("dst") == anchor).select(
        F.col("src").alias("v1"), F.col("edges").alias("matches")
    )
    if distinct:
        paths = paths.filter(_not_seen("v1", anchor, 1))
    for hop in range(2, hops + 1):
        last, new = f"v{hop - 1}", f"v{hop}"
        step = routes.steps.select(
            F.col("src").alias(new), F.col("dst").alias(last), F.col("edges").alias("_edges")
        )
        paths = step.join(paths, last)
        if distinct:
            paths = paths.filter(_not_seen(new, anchor, hop))
        paths = paths.withColumn("matches", F.col("matches") * F.col("_edges")).drop("_edges")
    return paths.select(*[f"v{i}" for i in range(1, hops + 1)], "matches")


def _count_into(g: Graph, anchor: str, distinct: bool) -> DataFrame:
    """Edges into the anchor from known vertices; reads only those, without a merge of all."""
    ids = _ids(g)
    into = g.edges.filter((F.col("dst") == anchor) & F.col("src").isNotNull())
    if distinct:
        into = into.filter(F.col("src") != anchor)
    per_source = into.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("matches"))
    known = per_source.join(ids.toDF("src"), "src", "left_semi").join(
        ids.filter(F.col("id") == anchor).toDF("dst"), "dst", "left_semi"
    )
    return known.agg(F.coalesce(F.sum("matches"), F.lit(0).cast("bigint")).alias("matches"))


def count_motif(
    g: Graph, anchor: str, hops: int = 1, distinct: bool = False, routes: Routes | None = None
) -> DataFrame:
    """One row: how many matches ``find_motif`` has.

    The last hop is never enumerated. Its matches are the in-degree of the vertex before it,
    less the edges that come from vertices already on the path. A three-hop count
    therefore makes no more rows than the graph has distinct edges.
    """
    if hops == 1:
        return _count_into(g, anchor, distinct)
    routes = routes or merge_routes(g)
    nothing = F.lit(0).cast("bigint")
    last = f"v{hops - 1}"
    paths = _paths(routes, anchor, hops - 1, distinct)
    closing, taken = F.sum("edges"), nothing
    if distinct:
        banned = (F.col("src") == anchor) | (F.col("src") == F.col("dst"))
        closing = F.sum(F.when(banned, nothing).otherwise(F.col("edges")))
        # edges from the other vertices of the path back to its last one, looked up by both
        # ends: (src, dst) is unique
        for hop in range(1, hops - 1):
            back = routes.steps.select(
                F.col("src").alias(f"v{hop}"),
                F.col("dst").alias(last),
                F.col("edges").alias(f"_back{hop}"),
            )
            paths = paths.join(back, [f"v{hop}", last], "left")
            taken = taken + F.coalesce(F.col(f"_back{hop}"), nothing)
    into = routes.steps.groupBy(F.col("dst").alias(last)).agg(closing.alias("_into"))
    per_vertex = paths.groupBy(last).agg(
        F.sum("matches").alias("_ways"), F.sum(F.col("matches") * taken).alias("_taken")
    )
    total = F.sum(F.col("_ways") * F.col("_into") - F.col("_taken"))
    return per_vertex.join(into, last).agg(F.coalesce(total, nothing).alias("matches"))


BITS = 64  # landmarks of one number


def distances_to(g: Graph, landmarks: list[str], routes: Routes | None = None) -> DataFrame:
    """Hops from every vertex to each landmark it can reach: ``id``, ``landmark``, ``hop``.

    Breadth-first from all landmarks at once, against the direction of the edges. The newest vertices
    have one row each, with a set of bits that says from which landmarks they were just reached, so a
    round joins each edge once however many landmarks there are. What is new in a round is written as
    one partition ``hop=k`` of a table; the bits are read as rows at the end. A landmark that is no
    vertex is reached from nowhere.
    """
    marks = list(dict.fromkeys(landmarks))
    names = [f"bits{w}" for w in range(-(-len(marks) // BITS) or 1)]
    with Stage(g.edges.sparkSession) as stage:
        own_routes = None if routes else merge_routes(g)
        steps = (routes or own_routes).steps.select("src", F.col("dst").alias("id"))
        place = F.array_position(F.array(*map(F.lit, marks)), F.col("id")) - 1 if marks else F.lit(0)
        own = [
            F.when(F.floor(place / BITS) == w, F.expr("shiftleft(1L, CAST(_place % 64 AS INT))"))
            .otherwise(F.lit(0).cast("long"))
            .alias(name)
            for w, name in enumerate(names)
        ]
        start = _ids(g).filter(F.col("id").isin(marks)).withColumn("_place", place)
        newest = stage.put(start.select("id", *own), "reached/hop=0")
        hop = 0
        while not newest.isEmpty():
            seen = _reached(stage, names).groupBy("id").agg(*[F.bit_or(n).alias(f"_{n}") for n in names])
            found = (
                steps.join(newest, "id")
                .groupBy(F.col("src").alias("id"))
                .agg(*[F.bit_or(n).alias(n) for n in names])
                .join(seen, "id", "left")
            )
            new = [
                F.col(n).bitwiseAND(F.bitwise_not(F.coalesce(f"_{n}", F.lit(0).cast("long")))).alias(n)
                for n in names
            ]
            fresh = found.select("id", *new).filter(" OR ".join(f"{n} <> 0" for n in names))
            hop += 1
            newest = stage.put(fresh, f"reached/hop={hop}")
        stage.close("reached")
        if own_routes:
            own_routes.stage.remove()
    which = F.array(
        *[
            F.when(F.getbit(names[i // BITS], F.lit(i % BITS)) == 1, F.lit(mark))
            for i, mark in enumerate(marks)
        ]
    )
    return _reached(stage, names).select(
        "id", F.explode(F.array_compact(which.cast("array<string>"))).alias("landmark"), "hop"
    )


def _reached(stage: Stage, names: list[str]) -> DataFrame:
    bits = ", ".join(f"{n} long" for n in names)
    return stage.spark.read.schema(f"id string, {bits}, hop int").parquet(stage.path("reached"))


def distance_map(distances: DataFrame) -> DataFrame:
    """One row per vertex with a map from landmark to hops."""
    pairs = F.collect_list(F.struct("landmark", "hop"))
    return distances.groupBy("id").agg(F.map_from_entries(pairs).alias("distances"))


def farthest(
    g: Graph,
    landmark: str,
    attributes: tuple[str, ...] = ("name",),
    routes: Routes | None = None,
) -> DataFrame:
    """The reachable vertices with the most hops to the landmark, with their attributes."""
    distances = distances_to(g, [landmark], routes)
    most = distances.select(F.max("hop")).scalar()
    ends = distances.filter(F.col("hop") == most).select("id", F.col("hop").alias("distance"))
    return ends.join(g.vertices.select("id", *attributes), "id")


def connected_components(g: Graph) -> DataFrame:
    """The smallest vertex id of each vertex's component, edges taken as undirected.

    First vertices with a single neighbour are peeled off: the neighbour keeps the smallest id of those
    that hung on it, and they are put back at the end. Of two vertices that have only each other the
    larger hangs on the smaller. What is left alternates the large-star and small-star steps of
    Kiveris et al., "Connected Components in MapReduce and Beyond" (2014), until every vertex hangs
    on the smallest id around it, however many rounds that takes. Runs jobs at once; tables of earlier
    rounds are removed.
    """
    with Stage(g.edges.sparkSession) as stage:
        ids = stage.put(_ids(g), "ids")
        links = g.edges.filter("src <> dst").select(
            F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")
        )
        for end in ("a", "b"):
            links = links.join(ids.toDF(end), end, "left_semi")
        links = stage.put(links.select("a", "b").distinct(), "links-all")
        hung, links = _peel(links, stage)
        turn = 0
        while not _settled(links):
            large = _large_star(links, stage, turn)
            links = stage.put(_small_star(large, stage, turn), f"links-{turn + 1}")
            stage.remove(*(f"{name}-{turn}" for name in ("links", "below", "large", "lowest")))
            turn += 1
        # every vertex of what is left, and what hung on it, with the vertex in its centre
        centres = links.select(F.col("a").alias("id"), F.col("b").alias("_centre"))
        stems = hung.groupBy(F.col("on").alias("id")).agg(F.min("id").alias("_low"))
        stems = stems.join(centres, "id", "left").select(
            "id", F.coalesce("_centre", "id").alias("_centre"), "_low"
        )
        stems = stage.put(stems, "stems")
        # a peeled vertex may be the smallest of a component: the centre's name changes to it then
        renamed = stems.groupBy("_centre").agg(F.min("_low").alias("_low"))
        renamed = stage.put(renamed.filter("_low < _centre"), "renamed")
        leaves = hung.join(stems.select(F.col("id").alias("on"), "_centre"), "on").select("id", "_centre")
        placed = stage.put(centres.union(leaves), "placed")
        stage.close("ids", "placed", "renamed")
    named = ids.join(placed, "id", "left").withColumn("_centre", F.coalesce("_centre", "id"))
    return named.join(renamed, "_centre", "left").select(
        "id", F.coalesce("_low", "_centre").alias("component")
    )


def _peel(links: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """``id`` and ``on`` of every vertex with one neighbour ``on``, and the links between the others.

    Of two vertices that are each other's only neighbour just the larger is peeled.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    single = ends.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select("id")
    single = stage.put(single, "single")
    marked = links.join(single.select(F.col("id").alias("a"), F.lit(1).alias("_a")), "a", "left")
    marked = marked.join(single.select(F.col("id").alias("b"), F.lit(1).alias("_b")), "b", "left")
    marked = stage.put(marked, "marked")
    larger = F.col("_a") == 1
    hung = marked.filter("_a = 1 OR _b = 1").select(
        F.when(larger, F.col("a")).otherwise(F.col("b")).alias("id"),
        F.when(larger, F.col("b")).otherwise(F.col("a")).alias("on"),
    )
    rest = marked.filter("_a IS NULL AND _b IS NULL").select("a", "b")
    hung, rest = stage.put(hung, "hung"), stage.put(rest, "links-0")
    stage.remove("links-all", "single", "marked")
    return hung, rest


def _settled(links: DataFrame) -> bool:
    """Whether every vertex hangs on one other at most and nothing hangs on those that do."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("up")),
                                          F.struct(F.col("b").alias("id"), F.lit(0).alias("up")))))
    counted = ends.groupBy("col.id").agg(F.sum("col.up").alias("up"), F.min("col.up").alias("least"))
    return counted.filter("up > 1 OR (up = 1 AND least = 0)").isEmpty()


def _large_star(links: DataFrame, stage: Stage, turn: int) -> DataFrame:
    """Link each larger neighbour of ``b`` to the smallest vertex around ``b``."""
    # b is below each a, so the smallest vertex around b is b or a smaller neighbour
    below = stage.put(
        links.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("_low")), f"below-{turn}"
    )
    moved = links.join(below, "b", "left").select("a", F.coalesce("_low", "b").alias("b"))
    return stage.put(moved.distinct(), f"large-{turn}")


def _small_star(links: DataFrame, stage: Stage, turn: int) -> DataFrame:
    """Link each vertex and its smaller neighbours to the smallest of them."""
    lowest = stage.put(links.groupBy("a").agg(F.min("b").alias("_low")), f"lowest-{turn}")
    moves = F.col("b") != F.col("_low")
    # the smallest neighbour keeps its link to a, every other one is linked to the smallest
    moved = links.join(lowest, "a").select(
        F.when(moves, F.col("b")).otherwise(F.col("a")).alias("a"), F.col("_low").alias("b")
    )
    return moved.distinct()


def component_sizes(components: DataFrame, min_size: int = 2) -> DataFrame:
    """Components with at least ``min_size`` vertices, and their size."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.filter(F.col("n") >= min_size)
