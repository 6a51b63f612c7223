"""One named query per analysis: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchkit import sources
from batchkit.functions import arrays
from batchkit.operators import basket, classify, cohorts, graph, occupancy, rank, ratings, text
from batchkit.operators.staging import Stage
from batchkit.plans import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# text counting


@query
def word_count(spark, sf_dir):
    return text.word_counts(tables.lines(spark, sf_dir))


@query
def ngram_count_1(spark, sf_dir):
    return text.ngram_counts(tables.lines(spark, sf_dir), 1)


@query
def ngram_count_2(spark, sf_dir):
    return text.ngram_counts(tables.lines(spark, sf_dir), 2)


@query
def prefix_word_count(spark, sf_dir):
    return text.prefix_word_counts(tables.lines(spark, sf_dir), "the")


@query
def prefix_word_counters(spark, sf_dir):
    return text.prefix_counters(tables.lines(spark, sf_dir), "the")


@query
def prefix_near_max(spark, sf_dir):
    words = text.ngram_counts(tables.lines(spark, sf_dir), 1)
    return text.near_max(words.withColumnRenamed("ngram", "word"), "th", 0.02)


@query
def prefix_words_observed(spark, sf_dir):
    """Counts and totals of one pass: how often each word occurs, and its share of the chosen words."""
    counts, totals = text.prefix_words_and_totals(tables.lines(spark, sf_dir), "the")
    chosen, others = (totals.select(name).scalar() for name in totals.columns)
    return counts.withColumns({"selected_words": chosen, "unselected_words": others})


@query
def key_value_round_trip(spark, sf_dir):
    """The counts of prefix words, the empty word too, written as key and value and read again."""
    stage = Stage(spark)
    sources.write_key_value(
        text.prefix_word_counts(tables.lines(spark, sf_dir), "the"), stage.path("counts")
    )
    return sources.read_key_value(spark, stage.path("counts"), "word string, n bigint")


@query
def csv_round_trip(spark, sf_dir):
    """All events as CSV with header and back, with a text that has blanks, quotes and separators."""
    stage = Stage(spark)
    events = tables.load(spark, sf_dir, "events")
    odd = F.when(F.col("event_id") % 5 == 0, "").when(F.col("event_id") % 7 == 0, F.lit(None))
    events = events.withColumn("odd", odd.otherwise(F.concat(F.lit(' ,"'), "event_type", F.lit(" "))))
    sources.write_csv(events, stage.path("events"), header=True)
    return sources.read_table(spark, stage.path("events"), events.schema)


@query
def parse_register(spark, sf_dir):
    """Readings written as tab-separated lines under a header, with their own form of timestamps."""
    stage = Stage(spark)
    stamp = "dd/MM/yyyy HH:mm:ss"
    readings = tables.readings(spark, sf_dir).withColumn("timestamp", F.date_format("timestamp", stamp))
    lines = sources.to_csv_line(readings, readings.columns, "\t")
    header = spark.range(1).select(F.lit("\t".join(readings.columns)).alias("line"))
    sources.write_lines(lines.union(header), stage.path("register"))
    body = sources.drop_header(
        sources.read_lines(spark, stage.path("register")), "\t".join(readings.columns)
    )
    schema = "station bigint, timestamp timestamp_ntz, used_slots int, free_slots bigint"
    return sources.parse_delimited(body, schema, "\t", timestamp_format=stamp)


@query
def inferred_stations(spark, sf_dir):
    """Stations written with tabs and a header, read with inferred types, named and asked by SQL."""
    path = Stage(spark).path("stations")
    sources.write_csv(tables.stations(spark, sf_dir), path, header=True, sep="\t")
    stations = sources.read_table(spark, path, sep="\t", infer=True)
    sources.register(stations, "inferred_stations")
    return spark.sql(
        "SELECT latitude, count(*) AS stations, min(longitude) AS west, max(longitude) AS east, "
        "max(id) AS last_id FROM inferred_stations WHERE longitude > 0 GROUP BY latitude"
    )


@query
def single_file_lines(spark, sf_dir):
    """Parts as lines of one file in order of their key, read again with the number of files."""
    path = Stage(spark).path("parts")
    parts = tables.load(spark, sf_dir, "part")
    lines = sources.to_csv_line(parts, ["p_partkey", "p_brand", "p_size"], ";")
    key = F.split("line", ";")[0].cast("long")
    sources.write_lines(lines, path, single_file=True, order=[key])
    files = sources.read_lines(spark, path).select("line", F.input_file_name().alias("_file"))
    count = files.agg(F.count_distinct("_file").alias("n")).scalar()
    return files.select("line", count.alias("files"))


# baskets


@query
def order_index_pairs(spark, sf_dir):
    """Pairs at positions i < j of the sorted products of each order, which has a few lines."""
    lists = basket.baskets(tables.load(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    pairs = lists.select("basket", F.inline(arrays.pairs(F.col("products"))))
    return pairs.withColumnsRenamed({"first": "product_a", "second": "product_b"})


@query
def user_product_chunks(spark, sf_dir):
    """Sorted products of each customer in chunks of 20, as one text for each chunk."""
    chunks = basket.basket_chunks(tables.purchases(spark, sf_dir), "o_custkey", "l_partkey", 20)
    products = F.array_join(F.col("products").cast("array<string>"), ",")
    return chunks.select("basket", "part", products.alias("products"))


@query
def user_product_lists(spark, sf_dir):
    """Sorted products of each order, as one text."""
    lists = basket.baskets(tables.load(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    return lists.select("basket", F.array_join(F.col("products").cast("array<string>"), ",").alias("products"))


@query
def basket_pair_count(spark, sf_dir):
    lines = tables.load(spark, sf_dir, "lineitem")
    counted = basket.pair_counts(lines, "l_orderkey", "l_partkey")
    # most counts are equal, so the pair is part of the order: no range holds most of the rows
    return counted.orderBy(F.desc("n"), "product_a", "product_b")


@query
def basket_pair_count_repeats(spark, sf_dir):
    lines = tables.load(spark, sf_dir, "lineitem")
    return basket.pair_counts(lines, "l_orderkey", "l_partkey", distinct=False)


@query
def basket_pair_topk(spark, sf_dir):
    return basket.top_pairs(tables.purchases(spark, sf_dir), "o_custkey", "l_partkey", 5)


# ratings


@query
def user_zscore(spark, sf_dir):
    scores = tables.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return ratings.zscore(scores, "l_orderkey", "l_quantity").withColumn(
        "zscore", F.round("zscore", 4)
    )


@query
def product_mean_zscore(spark, sf_dir):
    scores = tables.load(spark, sf_dir, "lineitem")
    means = ratings.mean_normalised(scores, "l_suppkey", "l_partkey", "l_quantity")
    return means.withColumn("mean_zscore", F.round("mean_zscore", 4))


# cohorts


@query
def two_level_count(spark, sf_dir):
    return cohorts.two_level_count(tables.residents(spark, sf_dir), "country", "continent", 60)


@query
def all_match_groups(spark, sf_dir):
    lines = tables.load(spark, sf_dir, "lineitem")
    return cohorts.all_match(lines, "l_orderkey", F.col("l_returnflag") == "N")


@query
def distinct_per_user_year(spark, sf_dir):
    views = tables.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("LID"), F.col("l_shipdate").alias("time")
    )
    lectures = tables.load(spark, sf_dir, "part").filter(F.col("p_brand") == "Brand#2")
    owners = tables.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("SID")
    )
    return cohorts.distinct_views_per_year(
        views, lectures.select(F.col("p_partkey").alias("LID")), (1997, 1999),
        owners=owners, owner_key="l_orderkey",
    )


@query
def zero_filled_year_counts(spark, sf_dir):
    return tables.view_counts(spark, sf_dir)


@query
def min_max_year_select(spark, sf_dir):
    return cohorts.select_extremes(
        tables.order_view_counts(spark, sf_dir), "views_1996", "views_1999"
    )


@query
def exceeding_organizers(spark, sf_dir):
    return cohorts.exceeding_organizers(
        tables.meetings(spark, sf_dir), tables.invitations(spark, sf_dir), more_than=5
    )


@query
def low_participation_meetings(spark, sf_dir):
    return cohorts.low_participation_meetings(
        tables.meetings(spark, sf_dir),
        tables.invitations(spark, sf_dir),
        tables.participations(spark, sf_dir),
        potential_above=3,
    )


# slot criticality


def _slots(spark, sf_dir, threshold):
    return occupancy.slot_criticality(tables.readings(spark, sf_dir), threshold)


def _worst_located(spark, sf_dir):
    worst = occupancy.most_critical_per_station(_slots(spark, sf_dir, 0.2))
    return occupancy.locate(worst, tables.stations(spark, sf_dir))


@query
def slot_criticality(spark, sf_dir):
    return _slots(spark, sf_dir, 0.3)


@query
def slot_criticality_sql(spark, sf_dir):
    return occupancy.slot_criticality_sql(
        spark, tables.readings(spark, sf_dir), tables.stations(spark, sf_dir), 0.3
    )


@query
def critical_slots_located(spark, sf_dir):
    return occupancy.located_report(_slots(spark, sf_dir, 0.3), tables.stations(spark, sf_dir))


@query
def critical_top1(spark, sf_dir):
    return occupancy.most_critical(_slots(spark, sf_dir, 0.2))


@query
def critical_top5(spark, sf_dir):
    return occupancy.top_critical(_slots(spark, sf_dir, 0.2), 5)


@query
def most_critical_per_station(spark, sf_dir):
    return _worst_located(spark, sf_dir)


@query
def critical_kml(spark, sf_dir):
    return occupancy.to_kml(_worst_located(spark, sf_dir))


@query
def critical_tsv(spark, sf_dir):
    return occupancy.to_tsv(_worst_located(spark, sf_dir))


@query
def top_slots_per_station(spark, sf_dir):
    order = [F.desc("criticality"), F.desc("hour"), F.desc("weekday")]
    return rank.top_per_group(_slots(spark, sf_dir, 0.2), ["station"], order, 3)


# classification


@query
def label_rows(spark, sf_dir):
    rated = classify.with_label(
        tables.rated_orders(spark, sf_dir), "kept", "lines", required=("o_orderpriority",)
    )
    return rated.select("o_orderkey", "kept", "lines", "label")


TEXTS = {"text": 1000, "summary": 500}


@query
def classifier_split(spark, sf_dir):
    side = classify.in_training(F.col("doc_id"))
    return tables.labelled_documents(spark, sf_dir).select(
        "doc_id", F.when(side, "train").otherwise("test").alias("side"), "label"
    )


@query
def classifier_features(spark, sf_dir):
    encoded = classify.encode(tables.labelled_documents(spark, sf_dir), TEXTS, ["doc_id"], ("score",))
    return encoded.select("doc_id", "score", "text_length", "text_words", "summary_length", "summary_words")


@query
def classifier_weights(spark, sf_dir):
    """Rows and inverse document frequency of every place that words of the training rows are hashed to."""
    encoded = classify.encode(tables.labelled_documents(spark, sf_dir), TEXTS, ["doc_id"])
    train, _ = classify.split(encoded, "doc_id")
    weights = classify.weight_rows(train, TEXTS)
    return weights.withColumn("weight", F.round("weight", 6))


@query
def text_classifier(spark, sf_dir):
    _, predictions = classify.fit_predict(
        tables.labelled_documents(spark, sf_dir), TEXTS, "doc_id", ("score",)
    )
    return predictions.select("doc_id", "label", "prediction")


@query
def classification_metrics(spark, sf_dir):
    scores = classify.metrics(tables.judged(spark, sf_dir))
    return scores.select(*[F.round(c, 6).alias(c) for c in scores.columns])


@query
def confusion_matrix(spark, sf_dir):
    return classify.confusion_matrix(tables.judged(spark, sf_dir))


@query
def per_class_scores(spark, sf_dir):
    scores = classify.per_class(tables.judged(spark, sf_dir))
    return scores.select(
        "class", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall")
    )


# route graph


@query
def in_degree_top10(spark, sf_dir):
    return graph.top_in_degree(tables.event_graph(spark, sf_dir), 10)


@query
def motif_1hop(spark, sf_dir):
    return graph.count_motif(tables.event_graph(spark, sf_dir), tables.LANDMARK, 1)


@query
def motif_2hop(spark, sf_dir):
    return graph.count_motif(tables.event_graph(spark, sf_dir), tables.LANDMARK, 2, distinct=True)


@query
def motif_3hop(spark, sf_dir):
    return graph.count_motif(tables.event_graph(spark, sf_dir), tables.LANDMARK, 3, distinct=True)


@query
def distances_to_landmark(spark, sf_dir):
    return graph.distances_to(tables.event_graph(spark, sf_dir), [tables.LANDMARK])


@query
def distances_two_landmarks(spark, sf_dir):
    """Hops to each of two landmarks, read from a map per vertex."""
    found = graph.distances_to(tables.event_graph(spark, sf_dir), [tables.LANDMARK, tables.LANDMARK_2])
    hops = F.col("distances")
    return graph.distance_map(found).select(
        "id", hops[tables.LANDMARK].alias("first"), hops[tables.LANDMARK_2].alias("second")
    )


@query
def farthest_vertices(spark, sf_dir):
    return graph.farthest(
        tables.event_graph(spark, sf_dir), tables.LANDMARK, ("name", "city", "country")
    )


@query
def connected_components(spark, sf_dir):
    return graph.connected_components(tables.page_graph(spark, sf_dir))


@query
def component_sizes(spark, sf_dir):
    return graph.component_sizes(graph.connected_components(tables.page_graph(spark, sf_dir)))
