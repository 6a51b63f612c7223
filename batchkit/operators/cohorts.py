"""Threshold, all-match, distinct and zero-filled counts over cohorts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from batchkit.operators.staging import Stage


def groups_at_least(df: DataFrame, group: list[str], minimum: int) -> DataFrame:
    """Groups with at least ``minimum`` rows, and their size ``n``."""
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= minimum)


def two_level_count(df: DataFrame, fine: str, coarse: str, minimum: int = 1000) -> DataFrame:
    """Per ``coarse`` group, the number of its ``fine`` groups with at least ``minimum`` rows."""
    kept = groups_at_least(df, [coarse, fine], minimum)
    return kept.groupBy(coarse).agg(F.count(F.lit(1)).alias("n"))


def all_match(df: DataFrame, group: str, condition: Column) -> DataFrame:
    """Groups in which every row meets the condition, with their size; NULL does not meet it."""
    met = F.coalesce(condition, F.lit(False))
    return (
        df.groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), F.bool_and(met).alias("_all"))
        .filter("_all")
        .drop("_all")
    )


def distinct_count(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distinct values per group.

    Spark removes duplicates by (group, value) first, so a large group is spread by its
    values before it is counted.
    """
    return df.groupBy(*group).agg(F.count_distinct(value).alias("n"))


def zero_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL becomes 0 in the listed columns, and only there."""
    return df.fillna(0, subset=columns)


def year_of(column: Column) -> Column:
    """The year of a date, a timestamp or a text that starts with four digits."""
    return F.substring(column.cast("string"), 1, 4).cast("int")


def in_years(df: DataFrame, time: str, first: int, last: int) -> Column:
    """Whether ``time`` lies in the years ``first`` to ``last``.

    Dates and timestamps are compared with the first day and the day after the last one, which
    the scan can use to skip files and row groups; texts go by ``year_of``.
    """
    if isinstance(df.schema[time].dataType, (DateType, TimestampType, TimestampNTZType)):
        start, end = datetime.date(first, 1, 1), datetime.date(last + 1, 1, 1)
        kind = df.schema[time].dataType.simpleString()
        return (F.col(time) >= F.lit(start).cast(kind)) & (F.col(time) < F.lit(end).cast(kind))
    return year_of(F.col(time)).between(first, last)


def distinct_views_per_year(
    views: DataFrame,
    lectures: DataFrame,
    years: tuple[int, int],
    student: str = "SID",
    lecture: str = "LID",
    time: str = "time",
    owners: DataFrame | None = None,
    owner_key: str | None = None,
) -> DataFrame:
    """Distinct lectures each student watched per year, for the given ``lectures`` only.

    Where the student of a view is in another table, ``owners`` is joined by ``owner_key`` once
    views of other lectures and years are gone. Spark broadcasts short lists of lectures and splits
    lectures that everybody watches.
    """
    kept = views.filter(in_years(views, time, *years)).join(
        lectures.select(lecture), lecture, "left_semi"
    )
    if owners is not None:
        kept = kept.join(owners, owner_key)
    seen = kept.select(student, year_of(F.col(time)).alias("year"), lecture)
    return distinct_count(seen, [student, "year"], lecture)


def zero_filled_counts(
    courses: DataFrame,
    lectures: DataFrame,
    views: DataFrame,
    columns: dict[str, Column],
    course: str = "CID",
    lecture: str = "LID",
) -> DataFrame:
    """Views per course for several conditions at once, 0 where there are none.

    ``columns`` maps an output name to a condition on ``views``. Every view counts, repeated
    ones too. Views are counted per lecture before they meet the lectures, so both joins are
    between tables with one row per key, and one pass serves all conditions.
    """
    names = list(columns)
    any_of = None
    for condition in columns.values():
        any_of = condition if any_of is None else any_of | condition
    per_lecture = (
        views.filter(any_of)
        .groupBy(lecture)
        .agg(*[F.count_if(c).alias(n) for n, c in columns.items()])
    )
    per_course = (
        lectures.select(lecture, course)
        .join(per_lecture, lecture)
        .groupBy(course)
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    return zero_fill(courses.select(course).join(per_course, course, "left"), names)


def select_extremes(df: DataFrame, lowest: str, highest: str) -> DataFrame:
    """Rows that have both the minimum of ``lowest`` and the maximum of ``highest``.

    The rows are written first, by a job that runs at once, so what they come from is computed once.
    """
    df = Stage(df.sparkSession).put(df, "counts")
    low = df.select(F.min(lowest)).scalar()
    high = df.select(F.max(highest)).scalar()
    return df.filter((F.col(lowest) == low) & (F.col(highest) == high))


def potential_participants(
    invitations: DataFrame, meeting: str = "MID", accepted: str = "Accepted"
) -> DataFrame:
    """Invitations answered Yes or Unknown per meeting."""
    return (
        invitations.filter(F.col(accepted).isin("Yes", "Unknown"))
        .groupBy(meeting)
        .agg(F.count(F.lit(1)).alias("potential"))
    )


def exceeding_organizers(
    meetings: DataFrame,
    invitations: DataFrame,
    more_than: int = 15,
    meeting: str = "MID",
    organizer: str = "OrganizerUID",
    limit: str = "MaxParticipants",
) -> DataFrame:
    """Organisers of more than ``more_than`` meetings with more potential participants than
    allowed."""
    potential = potential_participants(invitations, meeting)
    exceeded = (
        meetings.select(meeting, organizer, limit)
        .join(potential, meeting)
        .filter(F.col("potential") > F.col(limit))
    )
    return groups_at_least(exceeded, [organizer], more_than + 1).select(organizer)


def low_participation_meetings(
    meetings: DataFrame,
    invitations: DataFrame,
    participations: DataFrame,
    potential_above: int = 10,
    actual_below: int = 2,
    meeting: str = "MID",
    user: str = "UID",
    organizer: str = "OrganizerUID",
) -> DataFrame:
    """Per organiser, meetings with many potential and few distinct actual participants.

    Meetings nobody joined count as 0 participants; organisers without such a meeting are
    left out. All three inputs are reduced to one row per meeting before they are joined.
    """
    expected = potential_participants(invitations, meeting).filter(
        F.col("potential") > potential_above
    )
    actual = participations.groupBy(meeting).agg(F.count_distinct(user).alias("actual"))
    chosen = (
        meetings.select(meeting, organizer)
        .join(expected, meeting)
        .join(actual, meeting, "left")
        .filter(F.coalesce("actual", F.lit(0)) < actual_below)
    )
    return chosen.groupBy(organizer).agg(F.count(F.lit(1)).alias("n"))
