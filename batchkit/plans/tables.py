"""The given tables in the shapes that the analyses read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from batchkit import sources
from batchkit.operators import cohorts, graph

LANDMARK, LANDMARK_2 = "28", "7"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document."""
    return sources.explode_lines(load(spark, sf_dir, "documents"), "text")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item with the customer of its order."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return load(spark, sf_dir, "lineitem").join(orders, "l_orderkey")


def residents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their country and continent."""
    nations = load(spark, sf_dir, "nation")
    regions = load(spark, sf_dir, "region")
    return (
        load(spark, sf_dir, "customer")
        .select("c_nationkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("country"), F.col("r_name").alias("continent"))
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of a lecture: every line of an order."""
    return load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("LID"), "l_shipdate")


def view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses are customers, their lectures the orders."""
    customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CID"))
    return _view_counts(spark, sf_dir, customers, "o_custkey", (1998, 1999))


def order_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses are the orders, each with one lecture: itself."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("CID")).distinct()
    return _view_counts(spark, sf_dir, orders, "o_orderkey", (1996, 1999))


def _view_counts(
    spark: SparkSession, sf_dir: str, courses: DataFrame, course: str, years: tuple[int, ...]
) -> DataFrame:
    seen = views(spark, sf_dir)
    lectures = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("LID"), F.col(course).alias("CID")
    )
    chosen = {f"views_{y}": cohorts.in_years(seen, "l_shipdate", y, y) for y in years}
    return cohorts.zero_filled_counts(courses, lectures, seen, chosen)


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as meetings; the number in the priority is the limit of participants."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("MID"),
        F.col("o_custkey").alias("OrganizerUID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("MaxParticipants"),
    )


def invitations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as invitations, the return flag as the answer."""
    answer = F.when(F.col("l_returnflag") == "A", "Yes").when(
        F.col("l_returnflag") == "N", "Unknown"
    )
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("MID"),
        F.col("l_partkey").alias("UID"),
        answer.otherwise("No").alias("Accepted"),
    )


def participations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished line items as participations of their supplier."""
    return (
        load(spark, sf_dir, "lineitem")
        .filter(F.col("l_linestatus") == "F")
        .select(F.col("l_orderkey").alias("MID"), F.col("l_suppkey").alias("UID"))
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings of a station: an error has no free slot, a small one is a fault."""
    error = F.col("event_type") == "error"
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("station"),
        F.col("ts").alias("timestamp"),
        F.when(error & (F.col("value") < 20), 0).otherwise(1).alias("used_slots"),
        F.when(error, 0).otherwise(F.ceil("value")).alias("free_slots"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("longitude"),
        F.col("c_nationkey").alias("latitude"),
    )


def rated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines and the lines that were kept; 0 or NULL where there are none."""
    per_order = (
        load(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count_if(F.col("l_returnflag") != "R").alias("kept"),
            F.count(F.lit(1)).alias("lines"),
        )
    )
    return (
        load(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderpriority")
        .join(per_order, "o_orderkey", "left")
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = load(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("source").alias("summary"), F.col("n_chars").alias("score")
    )
    return labels.join(documents, "doc_id").dropna(subset=["text", "summary"])


def event_graph(spark: SparkSession, sf_dir: str) -> graph.Graph:
    """Customers as airports; each event is a route from its user to the key in its props."""
    airports = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").alias("country"),
    )
    flights = load(spark, sf_dir, "events").select(
        F.col("user_id").alias("src"), F.get_json_object("props", "$.k").alias("dst")
    )
    return graph.build(airports, flights)


def page_graph(spark: SparkSession, sf_dir: str) -> graph.Graph:
    """Sites and paths as vertices; each page links its site to its path."""
    parts = F.split(F.regexp_replace("url", "^https?://|[?#].*$", ""), "/", 2)
    pages = load(spark, sf_dir, "pages").select(
        parts[0].alias("src"), F.concat(F.lit("/"), parts[1]).alias("dst")
    )
    ids = pages.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return graph.build(ids, pages)
