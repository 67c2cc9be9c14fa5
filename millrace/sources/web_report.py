"""A web-analytics report computed from raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.calendar import micros
from millrace.workspace import cut_lineage

# Report headers by position.
REPORT_HEADERS = {
    "dimension_1": "date",
    "dimension_2": "pageTitle",
    "dimension_3": "pagePath",
    "metric_1": "totalUsers",
    "metric_2": "sessions",
    "metric_3": "newUsers",
    "metric_4": "averageSessionDuration",
    "metric_5": "bounceRate",
    "metric_6": "engagementRate",
    "metric_7": "conversions",
    "metric_8": "userEngagementDuration",
    "metric_9": "eventCount",
    "metric_10": "screenPageViews",
}
DIMENSIONS = ["date", "pageTitle", "pagePath"]
SECOND = 1_000_000


def _next_within(next_us: Column, gap: int) -> Column:
    return F.when(next_us - F.col("us") < gap, next_us).alias("next_us")


def sessionize(
    events: DataFrame, gap_seconds: int = 1800, bucket_seconds: int = 3600, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Add ``session_start``, ``next_us`` and ``first_us`` (microseconds) to events.

    A session of a user ends when nothing follows for ``gap_seconds``. ``events`` needs ``user_id``
    and ``us``, the event time in microseconds. ``next_us`` is the next event of the same session, or
    null, and ``first_us`` the user's first event. Events at the same moment are ordered by the
    ``tie_break`` columns; the last of them has what follows as its next.

    Events are ordered within pieces of ``bucket_seconds``, so a user with a large share of all events
    spreads over many tasks; take shorter pieces where one of them holds too many. One summary row per
    piece carries first and last event and the running session over the edges of the pieces.
    """
    gap = gap_seconds * SECOND
    piece = F.floor(F.col("us") / F.lit(bucket_seconds * SECOND))
    bucketed = events.withColumn("bucket", piece)
    key = ["user_id", "bucket"]
    inside = Window.partitionBy(*key).orderBy("us", *tie_break)
    marked = bucketed.select(
        "*",
        F.lag("us").over(inside).alias("previous_us"),
        F.lead("us").over(inside).alias("following_us"),
    )
    # Within a piece a start is certain only after a gap; the first row waits for its predecessor.
    inner_start = F.when(F.col("us") - F.col("previous_us") >= gap, F.col("us"))
    summary = marked.groupBy(*key).agg(
        F.min("us").alias("low"),
        F.max("us").alias("high"),
        F.max(inner_start).alias("last_inner_start"),
    )
    across = Window.partitionBy("user_id").orderBy("bucket")
    earlier = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = summary.select(
        "*",
        F.lag("high").over(across).alias("before"),
        F.lead("low").over(across).alias("after"),
        F.first("low").over(earlier).alias("first_us"),
    )
    opens = F.col("before").isNull() | (F.col("low") - F.col("before") >= gap)
    known = known.withColumn("own_start", F.when(opens, F.col("low")))
    last_start = F.coalesce("last_inner_start", "own_start")
    carried = F.last(last_start, ignorenulls=True).over(
        across.rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = known.select(
        F.col("user_id").alias("_user"), F.col("bucket").alias("_bucket"), "high", "after", "first_us",
        F.coalesce(F.col("own_start"), carried).alias("opening_start"),
    )
    latest = F.max(inner_start).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("bucket") == F.col("_bucket"))
    joined = marked.withColumn("latest_start", latest).join(edges, same)
    over_edge = F.when(F.col("us") == F.col("high"), F.col("after"))
    return joined.select(
        *events.columns,
        F.coalesce("latest_start", "opening_start").alias("session_start"),
        _next_within(F.coalesce(F.col("following_us"), over_edge), gap),
        "first_us",
    )


def web_report(
    events: DataFrame,
    gap_seconds: int = 1800,
    engaged_seconds: int = 10,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Ten metrics per (date, pageTitle, pagePath).

    ``events`` needs ``ts``, ``user_id``, ``pageTitle``, ``pagePath``, ``is_view`` and
    ``is_conversion``. A session is engaged when it lasts longer than ``engaged_seconds``, holds a
    conversion, or holds two or more page views. Session metrics of a row count the sessions that
    touch it, each with its whole length. Engagement time of an event runs until the session's
    next event. New users are those whose first event belongs to the row. Events without a user are
    nobody's: they count as events, views and conversions only, and a row of nothing else has no
    duration or rates.
    """
    timed = events.withColumns({"us": micros(F.col("ts")), "date": F.to_date("ts")})
    rows = sessionize(timed.filter("user_id IS NOT NULL"), gap_seconds, bucket_seconds, ["pageTitle", "pagePath"])
    session = ["user_id", "session_start"]
    parts = rows.groupBy(*DIMENSIONS, *session).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_view").alias("views"),
        F.count_if("is_conversion").alias("conversions"),
        F.sum(F.coalesce(F.col("next_us") - F.col("us"), F.lit(0))).alias("engagement_us"),
        F.max("us").alias("high"),
        F.max(F.col("us") == F.col("first_us")).alias("is_new"),
    )
    # Two branches follow; without a written copy each would scan and sessionize all events.
    parts = cut_lineage(parts, "report-parts")
    sessions = parts.groupBy(*session).agg(
        (F.max("high") - F.col("session_start")).alias("length_us"),
        F.sum("views").alias("session_views"),
        F.sum("conversions").alias("session_conversions"),
    )
    engaged = (
        (F.col("length_us") > engaged_seconds * SECOND)
        | (F.col("session_conversions") > 0)
        | (F.col("session_views") >= 2)
    )
    sessions = sessions.select(
        F.col("user_id").alias("_user"), F.col("session_start").alias("_start"), "length_us",
        engaged.alias("engaged"),
    )
    same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("session_start") == F.col("_start"))
    # A user with many sessions in one row is first reduced to one row per user.
    users = parts.join(sessions, same).groupBy(*DIMENSIONS, "user_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.max("is_new").alias("is_new"),
        F.sum("length_us").alias("length_us"),
        F.count_if("engaged").alias("engaged"),
        F.sum("conversions").alias("conversions"),
        F.sum("engagement_us").alias("engagement_us"),
        F.sum("events").alias("events"),
        F.sum("views").alias("views"),
    )
    nobody = timed.filter("user_id IS NULL").groupBy(*DIMENSIONS).agg(
        F.count_if("is_conversion").alias("conversions"), F.count(F.lit(1)).alias("events"),
        F.count_if("is_view").alias("views"),
    )
    nothing = F.lit(0).cast("bigint")
    total = users.unionByName(nobody, allowMissingColumns=True).groupBy(*DIMENSIONS).agg(
        F.count("user_id").alias("totalUsers"),
        F.coalesce(F.sum("sessions"), nothing).alias("sessions"),
        F.count_if("is_new").alias("newUsers"),
        F.coalesce(F.sum("length_us"), nothing).alias("length_us"),
        F.coalesce(F.sum("engaged"), nothing).alias("engaged"),
        F.sum("conversions").alias("conversions"),
        F.coalesce(F.sum("engagement_us"), nothing).alias("engagement_us"),
        F.sum("events").alias("eventCount"),
        F.sum("views").alias("screenPageViews"),
    )
    sessions = F.nullif(F.col("sessions"), F.lit(0))
    engagement = F.col("engaged") / sessions
    return total.select(
        *DIMENSIONS,
        "totalUsers",
        "sessions",
        "newUsers",
        (F.col("length_us") / sessions / SECOND).alias("averageSessionDuration"),
        (1 - engagement).alias("bounceRate"),
        engagement.alias("engagementRate"),
        "conversions",
        (F.col("engagement_us") / SECOND).alias("userEngagementDuration"),
        "eventCount",
        "screenPageViews",
    )
