import pytest
from pyspark.sql import functions as F

from batchkit.operators import occupancy, rank


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [
            (1, "2008-05-15 12:01:00", 0, 0),  # fault
            (1, "2008-05-15 12:31:00", 5, 0),
            (1, "2008-05-15 12:59:00", 3, 2),
            (1, "2008-05-15 13:00:00", 3, 2),
            (2, "2008-05-16 00:00:00", 3, 0),
        ],
        "station int, timestamp string, used_slots int, free_slots int",
    ).withColumn("timestamp", F.to_timestamp("timestamp", "yyyy-MM-dd HH:mm:ss"))


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(
        [(1, 2.18, 41.4, "A"), (3, 0.0, 0.0, "B")],
        "id int, longitude double, latitude double, name string",
    )


def test_slot_criticality(readings, rows):
    assert rows(occupancy.slot_criticality(readings)) == [
        (1, "Thu", 12, 0.5),
        (1, "Thu", 13, 0.0),
        (2, "Fri", 0, 1.0),
    ]
    # strictly above
    assert rows(occupancy.slot_criticality(readings, 0.5)) == [(2, "Fri", 0, 1.0)]


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.5])
def test_sql_and_dataframe_agree(spark, readings, stations, rows, threshold):
    by_sql = occupancy.slot_criticality_sql(spark, readings, stations, threshold)
    by_df = occupancy.located_report(occupancy.slot_criticality(readings, threshold), stations)
    assert by_sql.columns == by_df.columns
    assert rows(by_sql) == rows(by_df)


@pytest.fixture
def tied(spark):
    return spark.createDataFrame(
        [(1, "Mon", 9, 0.5), (1, "Tue", 9, 0.5), (1, "Mon", 8, 0.5), (1, "Wed", 23, 0.4)],
        "station int, weekday string, hour int, criticality double",
    )


def test_ties(tied, rows):
    assert rows(occupancy.most_critical_per_station(tied)) == [(1, "Tue", 9, 0.5)]
    assert rows(occupancy.most_critical_per_station(tied, "earliest")) == [(1, "Mon", 8, 0.5)]
    with pytest.raises(ValueError):
        occupancy.most_critical_per_station(tied, "first")
    assert rows(occupancy.most_critical(tied)) == [(1, "Tue", 9, 0.5)]
    best = [tuple(r) for r in occupancy.top_critical(tied, 2).collect()]
    assert best == [(1, "Mon", 8, 0.5), (1, "Mon", 9, 0.5)]


def test_window_route_finds_the_same_slot(tied, rows):
    order = [F.desc("criticality"), F.desc("hour"), F.desc("weekday")]
    by_window = rank.top_per_group(tied, ["station"], order)
    by_aggregate = occupancy.most_critical_per_station(tied)
    assert rows(by_window) == rows(by_aggregate)


def test_formats(spark, readings, stations, rows):
    worst = occupancy.most_critical_per_station(occupancy.slot_criticality(readings, 0.2))
    located = occupancy.locate(worst, stations)  # station 2 is unknown
    assert rows(occupancy.to_tsv(located)) == [("1\tThu\t12\t2.18\t41.4",)]
    assert rows(occupancy.to_kml(located)) == [
        (
            '<Placemark><name>1</name><ExtendedData><Data name="DayWeek"><value>Thu</value></Data>'
            '<Data name="Hour"><value>12</value></Data><Data name="Criticality"><value>0.5</value>'
            "</Data></ExtendedData><Point><coordinates>2.18,41.4</coordinates></Point></Placemark>",
        )
    ]
    odd = located.withColumn("station", F.lit("<A & B>"))
    assert "<name>&lt;A &amp; B&gt;</name>" in occupancy.to_kml(odd).first().line


def test_time_zone_of_the_session_does_not_matter(spark, rows):
    df = spark.sql(
        "SELECT 1 AS station, TIMESTAMP_NTZ'2024-03-31 02:30:00' AS timestamp, 1 AS used_slots, "
        "0 AS free_slots"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Rome", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert rows(occupancy.slot_criticality(df)) == [(1, "Sun", 2, 1.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
