"""Products that occur together in a basket."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from batchkit.operators import rank
from batchkit.operators.staging import Stage

# Products of a block. A cell makes at most about BLOCK * BLOCK pairs, and copying the
# products of a large basket to their cells adds 2 / BLOCK rows per pair.
BLOCK = 128


def basket_items(df: DataFrame, basket: str, product: str) -> DataFrame:
    """One row per basket and product, with the number of copies.

    Copies are combined before the shuffle, whichever basket or product they crowd into.
    """
    return (
        df.filter(F.col(basket).isNotNull() & F.col(product).isNotNull())
        .groupBy(F.col(basket).alias("basket"), F.col(product).alias("product"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def baskets(df: DataFrame, basket: str, product: str) -> DataFrame:
    """The sorted distinct products of each basket as one array.

    The array is the result here, so a basket must fit into one row; ``basket_chunks`` has no such
    limit, and counting pairs does not go through an array.
    """
    return (
        df.filter(F.col(basket).isNotNull() & F.col(product).isNotNull())
        .groupBy(F.col(basket).alias("basket"))
        .agg(F.sort_array(F.collect_set(product)).alias("products"))
    )


def _in_ranges(items: DataFrame, rows_per_range: int, stage: Stage) -> DataFrame:
    """The items in order of basket and product, cut into ranges (``_range``) of about equal size.

    A written table: the borders of the ranges come from a sample and are settled by writing. A basket
    with very many products lies in several ranges.
    """
    ranges = max(1, -(-items.count() // rows_per_range))
    ranged = items.repartitionByRange(ranges, "basket", "product")
    return stage.put(ranged.withColumn("_range", F.spark_partition_id()), "ranged")


def basket_chunks(
    df: DataFrame, basket: str, product: str, size: int = 1000, rows_per_range: int = 100_000
) -> DataFrame:
    """The sorted distinct products of each basket in chunks: ``basket``, ``part``, ``products``.

    Part 0 holds the first ``size`` products, part 1 the next, and so on, so the parts of a basket in
    order are what ``baskets`` returns as one array. No task holds a whole large basket: its products
    are numbered range by range, each range counting on from the sum of those before it, and met
    again chunk by chunk. Where the ranges are cut does not show in the result. Rows without a basket or
    product are left out, copies count once. Items and ranges are written, by jobs that run at once.
    """
    with Stage(df.sparkSession) as stage:
        items = stage.put(basket_items(df, basket, product).select("basket", "product"), "items")
        ranged = _in_ranges(items, rows_per_range, stage)
        counts = ranged.groupBy("basket", "_range").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy("basket").orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        # only ranges that do not begin their basket: few, as a range holds many baskets or part of one
        before = counts.withColumn("_before", F.sum("_n").over(earlier)).filter("_before > 0")
        before = stage.put(before.drop("_n"), "before")
        stage.close("ranged", "before")
    inside = F.row_number().over(Window.partitionBy("basket", "_range").orderBy("product"))
    numbered = ranged.withColumn("_place", inside).join(before, ["basket", "_range"], "left")
    place = F.col("_place") - 1 + F.coalesce("_before", F.lit(0))
    return (
        numbered.groupBy("basket", F.floor(place / size).cast("int").alias("part"))
        .agg(F.sort_array(F.collect_list("product")).alias("products"))
    )


def _cells(items: DataFrame, block: int, stage: Stage, name: str) -> DataFrame:
    """Deal the items of large baskets to cells of bounded size; ``items`` is a written table.

    A basket of d products is cut into ceil(d / block) blocks by a hash of the product.
    Cell (i, j) receives block i and block j, so every pair of products meets in exactly one
    cell. Ordinary baskets are a single cell. The sizes of all larger baskets are written, so
    Spark picks the join by their number and splits the items of a very large basket.
    """
    large = (
        items.groupBy("basket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .filter(F.col("_size") > block)
        .select("basket", F.ceil(F.col("_size") / block).cast("int").alias("_blocks"))
    )
    tagged = items.join(stage.put(large, f"large-{name}"), "basket", "left").withColumn(
        "_own",
        F.when(F.col("_blocks").isNull(), 0).otherwise(
            F.pmod(F.xxhash64("product"), F.col("_blocks")).cast("int")
        ),
    )
    others = F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)
    return tagged.withColumn("_other", F.explode(others)).withColumns(
        {"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}
    )


def _expand(cells: DataFrame, distinct: bool) -> DataFrame:
    """The pairs of each cell: within a block on the diagonal, between two blocks elsewhere."""
    entry = F.col("product") if distinct else F.struct("product", "copies")
    in_first = F.col("_own") == F.col("_i")
    members = cells.groupBy("basket", "_i", "_j").agg(
        F.collect_list(F.when(in_first, entry)).alias("_first"),
        F.collect_list(F.when(~in_first, entry)).alias("_second"),
    )
    opened = members.filter(F.size("_first") + F.size("_second") > 1).select(
        (F.col("_i") == F.col("_j")).alias("_diagonal"),
        "_first",
        "_second",
        F.posexplode("_first").alias("_pos", "_a"),
    )
    later = F.slice("_first", F.col("_pos") + 2, F.size("_first"))
    partners = F.when(F.col("_diagonal"), later).otherwise(F.col("_second"))
    return opened.select("_a", F.explode(partners).alias("_b"))


def pair_counts(
    df: DataFrame,
    basket: str,
    product: str,
    distinct: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """How many baskets hold each unordered pair of products: ``product_a <= product_b``, ``n``.

    With ``distinct=False`` repeated products count: a pair adds the product of both
    numbers of copies, and a product bought c times pairs c(c-1)/2 times with itself.
    The items and the sizes of large baskets are written, by jobs that run at once.
    """
    with Stage(df.sparkSession) as stage:
        items = stage.put(basket_items(df, basket, product), "items")
        return _pair_counts(items, distinct, block, stage, "all")


def _pair_counts(
    items: DataFrame, distinct: bool, block: int, stage: Stage, name: str
) -> DataFrame:
    pairs = _expand(_cells(items, block, stage, name), distinct)
    a, b = F.col("_a"), F.col("_b")
    if not distinct:
        pairs = pairs.withColumn("_n", a["copies"] * b["copies"])
        a, b = a["product"], b["product"]
    counted = pairs.groupBy(
        F.least(a, b).alias("product_a"), F.greatest(a, b).alias("product_b")
    ).agg((F.count(F.lit(1)) if distinct else F.sum("_n")).alias("n"))
    if distinct:
        return counted
    twice = (
        items.filter("copies > 1")
        .groupBy("product")
        .agg(F.sum(F.expr("copies * (copies - 1) div 2")).alias("n"))
    )
    return counted.unionByName(
        twice.select(F.col("product").alias("product_a"), F.col("product").alias("product_b"), "n")
    )


def top_pairs(
    df: DataFrame,
    basket: str,
    product: str,
    k: int = 5,
    head: int = 32,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` most frequent pairs of distinct products; ties go to the larger pair.

    A pair is never more frequent than its rarer product. The pairs among the ``head`` most
    frequent products give a lower bound for place k, and products in fewer baskets than
    that bound cannot be part of the answer. The bound only saves work: with or without
    it the result is the same.
    """
    with Stage(df.sparkSession) as stage:
        # read several times below, so written once
        items = stage.put(basket_items(df, basket, product).select("basket", "product"), "items")
        support = stage.put(
            items.groupBy("product").agg(F.count(F.lit(1)).alias("_baskets")), "support"
        )
        leaders = rank.top_k(support, [F.desc("_baskets"), F.col("product")], head).select("product")
        among = stage.put(items.join(leaders, "product", "left_semi"), "among")
        best = rank.top_k(
            _pair_counts(among, True, block, stage, "among").select("n"), [F.desc("n")], k
        )
        bound = best.agg(F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(0)).first()[0]
        frequent = support.filter(F.col("_baskets") >= bound).select("product")
        kept = stage.put(items.join(frequent, "product", "left_semi"), "kept")
        counted = _pair_counts(kept, True, block, stage, "kept")
        stage.close("kept", "large-kept")
        return rank.top_k(counted, [F.desc("n"), F.desc("product_a"), F.desc("product_b")], k)
