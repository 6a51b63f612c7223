"""How often each station is full, per weekday and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchkit.operators import rank

SLOT = ["station", "weekday", "hour"]


def slot_criticality(
    readings: DataFrame,
    threshold: float | None = None,
    station: str = "station",
    timestamp: str = "timestamp",
    used: str = "used_slots",
    free: str = "free_slots",
) -> DataFrame:
    """Share of readings without a free slot per (station, weekday, hour).

    Readings with neither used nor free slots are faults and left out. Only slots strictly
    above ``threshold`` are kept. All and full readings are counted in one pass.
    """
    valid = readings.filter(~((F.col(used) == 0) & (F.col(free) == 0)))
    slots = valid.groupBy(
        F.col(station).alias("station"),
        F.dayname(timestamp).alias("weekday"),
        F.hour(timestamp).alias("hour"),
    ).agg(F.count(F.lit(1)).alias("_all"), F.count_if(F.col(free) == 0).alias("_full"))
    result = slots.select(*SLOT, F.try_divide("_full", "_all").alias("criticality"))
    return result if threshold is None else result.filter(F.col("criticality") > threshold)


def slot_criticality_sql(
    spark: SparkSession, register: DataFrame, stations: DataFrame, threshold: float
) -> DataFrame:
    """The located critical slots as one SQL statement over the two named tables.

    Full and all readings come from one grouped pass instead of two that are joined.
    """
    return spark.sql(
        """
        WITH slots AS (
            SELECT station, dayname(timestamp) AS weekday, hour(timestamp) AS hour,
                   count_if(free_slots = 0) / count(*) AS criticality
            FROM {register}
            WHERE NOT (used_slots = 0 AND free_slots = 0)
            GROUP BY ALL
        )
        SELECT t.station AS station_id, t.weekday, t.hour, t.criticality, s.longitude, s.latitude
        FROM slots t, {stations} s
        WHERE s.id = t.station AND t.criticality > :threshold
        ORDER BY criticality DESC, station_id, weekday, hour
        """,
        args={"threshold": float(threshold)},
        register=register,
        stations=stations,
    )


def locate(slots: DataFrame, stations: DataFrame, station_id: str = "id") -> DataFrame:
    """Add longitude and latitude of the station; slots of unknown stations are dropped.

    Slots are already aggregated: a station has at most 7 x 24 of them, so no key is hot.
    """
    places = stations.select(F.col(station_id).alias("station"), "longitude", "latitude")
    return slots.join(places, "station")


def located_report(slots: DataFrame, stations: DataFrame) -> DataFrame:
    """Located slots, worst first, then by station, weekday and hour."""
    return (
        locate(slots, stations)
        .select(
            F.col("station").alias("station_id"),
            "weekday",
            "hour",
            "criticality",
            "longitude",
            "latitude",
        )
        .orderBy(F.desc("criticality"), "station_id", "weekday", "hour")
    )


def most_critical(slots: DataFrame) -> DataFrame:
    """The one worst slot; ties go to the later hour, then the larger weekday name."""
    order = [F.desc("criticality"), F.desc("hour"), F.desc("weekday"), F.col("station")]
    return rank.top_k(slots, order, 1)


def top_critical(slots: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` worst slots; ties in order of station, weekday and hour."""
    return rank.top_k(slots, [F.desc("criticality"), *[F.col(c) for c in SLOT]], k)


def most_critical_per_station(slots: DataFrame, tie: str = "latest") -> DataFrame:
    """The worst slot of every station.

    ``tie="latest"`` prefers the larger hour, then the larger weekday name;
    ``tie="earliest"`` the smaller ones. An aggregate, not a window: each task sends one row
    per station.
    """
    if tie not in ("latest", "earliest"):
        raise ValueError(f"unknown tie rule: {tie}")
    if tie == "latest":
        best = F.max(F.struct("criticality", "hour", "weekday"))
        worst = F.col("_best.criticality")
    else:
        best = F.min(F.struct((-F.col("criticality")).alias("criticality"), "hour", "weekday"))
        worst = -F.col("_best.criticality")
    return slots.groupBy("station").agg(best.alias("_best")).select(
        "station", "_best.weekday", "_best.hour", worst.alias("criticality")
    )


def _xml(column: Column) -> Column:
    text = column.cast("string")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


# Fixed value: the Placemark layout that map viewers of these files expect.
PLACEMARK = (
    "<Placemark><name>%s</name><ExtendedData>"
    '<Data name="DayWeek"><value>%s</value></Data>'
    '<Data name="Hour"><value>%s</value></Data>'
    '<Data name="Criticality"><value>%s</value></Data>'
    "</ExtendedData><Point><coordinates>%s,%s</coordinates></Point></Placemark>"
)


def to_kml(located: DataFrame) -> DataFrame:
    """One KML Placemark per located slot, in column ``line``."""
    fields = ["station", "weekday", "hour", "criticality", "longitude", "latitude"]
    return located.select(
        F.format_string(PLACEMARK, *[_xml(F.col(c)) for c in fields]).alias("line")
    )


def to_tsv(located: DataFrame) -> DataFrame:
    """Station, weekday, hour, longitude, latitude separated by tabs, in column ``line``."""
    fields = ["station", "weekday", "hour", "longitude", "latitude"]
    return located.select(
        F.concat_ws("\t", *[F.col(c).cast("string") for c in fields]).alias("line")
    )
