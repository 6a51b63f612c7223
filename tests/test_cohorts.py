import pytest
from pyspark.sql import functions as F

from batchkit.operators import cohorts


def test_pricing_plans(spark, rows):
    users = spark.createDataFrame(
        [("IT", "free"), ("IT", "business"), ("IT", "free"), ("FR", "free"), ("FR", "free"),
         ("DE", "business"), ("ES", None)],
        "country string, plan string",
    )
    assert rows(cohorts.all_match(users, "country", F.col("plan") == "free")) == [("FR", 2)]


def test_two_level_count(spark, rows):
    people = [("Europe", "IT")] * 3 + [("Europe", "FR")] * 2 + [("Europe", "DE")] + [("Asia", "JP")]
    df = spark.createDataFrame(people, "continent string, country string")
    assert rows(cohorts.two_level_count(df, "country", "continent", 2)) == [("Europe", 2)]
    assert rows(cohorts.groups_at_least(df, ["country"], 3)) == [("IT", 3)]


@pytest.fixture
def courses(spark):
    return spark.createDataFrame([("watched",), ("unwatched",), ("empty",)], "CID string")


@pytest.fixture
def lectures(spark):
    return spark.createDataFrame(
        [("l1", "watched"), ("l2", "watched"), ("l3", "unwatched")], "LID string, CID string"
    )


@pytest.fixture
def views(spark):
    return spark.createDataFrame(
        [
            ("s1", "2023/01/05", "l1"),
            ("s1", "2023/02/05", "l1"),
            ("s1", "2023/03/05", "l2"),
            ("s2", "2024/03/05", "l2"),
            ("s2", "2022/03/05", "l1"),
            ("s2", "2024/03/05", "unknown"),
        ],
        "SID string, time string, LID string",
    )


def test_zero_filled_counts(courses, lectures, views, rows):
    yearly = views.withColumn("year", cohorts.year_of(F.col("time")))
    counts = cohorts.zero_filled_counts(
        courses, lectures, yearly, {"y23": F.col("year") == 2023, "y24": F.col("year") == 2024}
    )
    # a repeated view counts again; courses without lectures or views have zeros
    assert rows(counts) == [("empty", 0, 0), ("unwatched", 0, 0), ("watched", 3, 1)]
    assert rows(cohorts.select_extremes(counts, "y24", "y23")) == []
    assert rows(cohorts.select_extremes(counts, "y23", "y24")) == []
    low = counts.withColumn("y24", F.lit(7))
    assert rows(cohorts.select_extremes(low, "y23", "y24")) == [("empty", 0, 7), ("unwatched", 0, 7)]


def test_extremes_of_nothing(spark, rows):
    df = spark.createDataFrame([], "a int, b int")
    assert rows(cohorts.select_extremes(df, "a", "b")) == []


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_distinct_views_per_year(lectures, views, rows, kind):
    watched = lectures.filter("CID = 'watched'")
    if kind != "string":
        views = views.withColumn("time", F.to_date("time", "yyyy/MM/dd").cast(kind))
    got = cohorts.distinct_views_per_year(views, watched, (2022, 2023))
    assert rows(got) == [("s1", 2023, 2), ("s2", 2022, 1)]


def test_the_student_may_be_in_another_table(spark, lectures, views, rows):
    owners = views.select("SID").distinct().withColumn("card", F.concat(F.lit("c"), "SID"))
    carded = views.join(owners, "SID").drop("SID")
    got = cohorts.distinct_views_per_year(
        carded, lectures, (2022, 2024), owners=owners, owner_key="card"
    )
    assert rows(got) == [("s1", 2023, 2), ("s2", 2022, 1), ("s2", 2024, 1)]


def test_years_end_at_midnight(spark, rows):
    df = spark.sql(
        "SELECT TIMESTAMP'1998-12-31 23:59:59.999999' t UNION ALL SELECT TIMESTAMP'1999-01-01' "
        "UNION ALL SELECT TIMESTAMP'1997-12-31 23:59:59' UNION ALL SELECT NULL"
    )
    assert df.filter(cohorts.in_years(df, "t", 1998, 1998)).count() == 1


def test_year_of_any_time(spark):
    got = spark.sql("SELECT '2024/02/07-20:40:10' a, DATE'2021-05-06' b, TIMESTAMP'1999-01-01 10:00:00' c")
    assert tuple(got.select(*[cohorts.year_of(F.col(x)) for x in "abc"]).first()) == (2024, 2021, 1999)


def test_distinct_count(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "k string, v int")
    assert rows(cohorts.distinct_count(df, ["k"], "v")) == [("a", 2), ("b", 0)]


def test_zero_fill_touches_listed_columns_only(spark, rows):
    df = spark.createDataFrame([(None, None)], "a int, b int")
    assert rows(cohorts.zero_fill(df, ["a"])) == [(0, None)]


# organiser -> (distinct actual, potential) of each meeting
EXAMPLE = {
    "UID1": [(3, 15), (0, 12), (0, 5)],
    "UID5": [(10, 15), (0, 15), (1, 5), (1, 12)],
    "UID12": [(10, 15), (5, 11), (0, 5), (5, 6)],
}


@pytest.fixture
def example(spark):
    meetings, invitations, participations = [], [], []
    for organizer, stats in EXAMPLE.items():
        for number, (actual, potential) in enumerate(stats):
            meeting = f"{organizer}-{number}"
            meetings.append((meeting, organizer, 11))
            for i in range(potential):
                invitations.append((meeting, f"u{i}", "Unknown" if i % 3 else "Yes"))
            invitations.append((meeting, "refused", "No"))
            for i in range(actual):
                # everybody leaves and joins again
                participations += [(meeting, f"u{i}", "10:00"), (meeting, f"u{i}", "11:00")]
    return (
        spark.createDataFrame(meetings, "MID string, OrganizerUID string, MaxParticipants int"),
        spark.createDataFrame(invitations, "MID string, UID string, Accepted string"),
        spark.createDataFrame(participations, "MID string, UID string, JoinTimestamp string"),
    )


def test_low_participation_meetings(example, rows):
    assert rows(cohorts.low_participation_meetings(*example)) == [("UID1", 1), ("UID5", 2)]


def test_exceeding_organizers(example, rows):
    meetings, invitations, _ = example
    assert rows(cohorts.exceeding_organizers(meetings, invitations, 2)) == [("UID5",)]
    assert rows(cohorts.exceeding_organizers(meetings, invitations, 1)) == [("UID1",), ("UID5",)]
    assert rows(cohorts.exceeding_organizers(meetings, invitations)) == []
