"""Zone-by-month panel with lags, trailing and forward sums.

A zone's months are at most the calendar, so per-zone arrays are bounded.  A zone is one dense array
indexed by month and the array of its prefix sums; all lags and sums are differences of two places of
that, read as months become rows.  The work is linear in the months.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessgrid.functions import scalars as fx

LAG_MONTHS = [3, 6, 12]
HORIZON = 12


def monthly_events(stations: DataFrame, zone_key: str = "zip") -> DataFrame:
    """New fast-charger ports and stations per zone and month."""
    keyed = stations.withColumn("zone", fx.numeric_key(F.col(zone_key)))
    year, month = F.col("install_year").try_cast("int"), F.col("install_month").try_cast("int")
    usable = keyed.where(
        F.col("zone").rlike(r"^\d{5,}$") & year.isNotNull() & month.between(1, 12)
    )
    return (
        usable.withColumn("month_start", fx.month_start(year, month))
        .groupBy("zone", "month_start")
        .agg(
            F.sum(F.coalesce(F.col("dcfc_ports").cast("double"), F.lit(0.0))).alias("new_ports"),
            F.sum(F.coalesce(F.col("is_dcfc").cast("double"), F.lit(0.0))).alias("new_stations"),
        )
    )


#: Months that are added up one by one; longer prefixes begin with whole blocks.
PREFIX_BLOCK = 16


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _dense(field: str) -> Column:
    """A zone's events, sorted by month, as one value for each month of the calendar; none counts zero."""

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0), n.cast("int"))

    def with_gap(event: Column, at: Column) -> Column:
        following = F.coalesce(F.get("_events", at + 1)["number"], F.col("_lo") + F.col("_n"))
        return F.concat(F.array(F.coalesce(event[field], F.lit(0.0))), zeros(following - event["number"] - 1))

    first = F.get("_events", F.lit(0))["number"]
    filled = F.concat(zeros(first - F.col("_lo")), F.flatten(F.transform("_events", with_gap)))
    return F.when(F.col("_events").isNull(), zeros(F.col("_n"))).otherwise(filled)


def _dense_sums(field: str) -> Column:
    """The sums of a zone's values before each month, and of all: a sum holds up to its event's month.

    Only events are added up; the months between them are copies.
    """
    sums = prefix_sums(F.transform("_events", lambda e: F.coalesce(e[field], F.lit(0.0))))
    months = (F.col("_n") + 1).cast("int")

    def filled(before: Column) -> Column:
        def with_gap(event: Column, at: Column) -> Column:
            following = F.coalesce(F.get("_events", at + 1)["number"], F.col("_lo") + F.col("_n"))
            return F.array_repeat(F.get(before, at + 1), (following - event["number"]).cast("int"))

        lead = F.get("_events", F.lit(0))["number"] - F.col("_lo") + 1
        return F.concat(F.array_repeat(F.lit(0.0), lead.cast("int")), F.flatten(F.transform("_events", with_gap)))

    return F.when(F.col("_events").isNull(), F.array_repeat(F.lit(0.0), months)).otherwise(fx.once(sums, filled))


def month_arrays(zones: DataFrame, monthly: DataFrame) -> DataFrame:
    """(zone, first, ports, stations, before): every zone once, with an array of all months between the
    first and last event of any zone, and the sums of ports before each of them; first is the month that
    the arrays begin with.

    A zone is a few bytes that become many rows, so the size of the zones must not decide how many
    tasks there are: they are dealt to all partitions of the session.
    """
    span = monthly.agg(
        F.struct(
            F.min("month_start").alias("first"),
            F.min(_month_number(F.col("month_start"))).alias("lo"),
            (F.max(_month_number(F.col("month_start"))) - F.min(_month_number(F.col("month_start"))) + 1).alias("n"),
        )
    )
    event = F.struct(_month_number(F.col("month_start")).alias("number"), "new_ports", "new_stations")
    per_zone = monthly.groupBy("zone").agg(F.array_sort(F.collect_list(event)).alias("_events"))
    parts = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = zones.select("zone").where(F.col("zone").isNotNull()).repartition(parts, "zone").distinct()
    joined = keys.join(per_zone, "zone", "left").withColumn("_span", span.scalar())
    known = joined.select("zone", "_events", F.col("_span.first").alias("first"), F.col("_span.lo").alias("_lo"), F.col("_span.n").alias("_n"))
    return known.select("zone", "first", _dense("new_ports").alias("ports"), _dense("new_stations").alias("stations"), _dense_sums("new_ports").alias("before"))


def _calendar(monthly: DataFrame) -> Column:
    """All months between the first and last event, as one array; labels are made once for a month, not for each row."""
    ends = F.struct(F.min("month_start").alias("first"), (F.max(_month_number(F.col("month_start"))) - F.min(_month_number(F.col("month_start")))).alias("last"))

    def month(at: Column) -> Column:
        start = F.add_months(F.col("_ends.first"), at).cast("date")
        return F.struct(
            start.alias("month_start"), F.month(start).alias("month_num"), F.year(start).alias("year_num"), fx.month_label(start).alias("year_month")
        )

    months = F.transform(F.sequence(F.lit(0), F.col("_ends.last").cast("int")), month)
    return monthly.agg(ends.alias("_ends")).select(months.alias("_months")).scalar()


def calendar_panel(zones: DataFrame, monthly: DataFrame) -> DataFrame:
    """Every zone with every month between the first and last event; no event counts zero.

    A zone's events travel as one small array, so only one row per zone is joined; the months
    are laid out afterwards.
    """
    laid_out = month_arrays(zones, monthly).select("zone", "first", F.posexplode(F.arrays_zip("ports", "stations")).alias("_at", "_month"))
    return laid_out.select(
        "zone",
        F.expr("cast(add_months(first, _at) as date)").alias("month_start"),
        F.col("_month.ports").alias("new_ports"),
        F.col("_month.stations").alias("new_stations"),
    )


def prefix_sums(values: Column) -> Column:
    """The array of sums of the first 0, 1, 2, ... values: whole blocks, and the rest of the last one."""

    def total(array: Column, start: Column, n: Column) -> Column:
        return F.aggregate(F.slice(array, start + 1, n), F.lit(0.0), lambda a, x: a + x)

    def blocks(array: Column) -> Column:
        return F.sequence(F.lit(0), F.floor(F.size(array) / PREFIX_BLOCK).cast("int"))

    def with_starts(starts: Column) -> Column:
        def prefix(i: Column) -> Column:
            block = F.floor(i / PREFIX_BLOCK).cast("int")
            return F.get(starts, block) + total(values, block * PREFIX_BLOCK, i % PREFIX_BLOCK)

        return F.transform(F.sequence(F.lit(0), F.size(values)), prefix)

    sums = F.transform(blocks(values), lambda b: total(values, b * PREFIX_BLOCK, F.lit(PREFIX_BLOCK)))
    starts = fx.once(sums, lambda s: F.transform(blocks(values), lambda b: total(s, F.lit(0), b)))
    return fx.once(starts, with_starts)


def temporal_panel(zones: DataFrame, monthly: DataFrame) -> DataFrame:
    """calendar_panel with the columns of add_temporal_features, by differences of prefix sums.

    The arrays are made below the explode and read above it, by place: plain columns of a month's row.
    """
    known = month_arrays(zones, monthly).where(F.col("first").isNotNull())
    months = known.select("*", F.explode(F.sequence(F.lit(0), F.size("ports") - 1)).alias("at"))
    i, n = F.col("at"), F.size("ports")

    def sum_of(start: Column, stop: Column) -> Column:
        return F.get("before", stop) - F.get("before", start)

    rows = months.select(
        "zone",
        "at",
        F.get("ports", i).alias("new_ports"),
        F.get("stations", i).alias("new_stations"),
        F.when(i >= 1, F.get("ports", i - 1)).alias("ports_lag_1m"),
        *[F.when(i >= k, sum_of(i - k, i)).alias(f"ports_lag_{k}m") for k in LAG_MONTHS],
        F.get("before", i).alias("ports_cum_to_date"),
        F.when(i + HORIZON < n, sum_of(i + 1, i + HORIZON + 1)).alias("ports_next_12m"),
        F.when((i >= HORIZON - 1) & (i + 1 < n), sum_of(i + 2 - HORIZON, i + 2)).alias("ports_trailing_incl_next_12m"),
    )
    month = F.get(_calendar(monthly), F.col("at"))
    return rows.select(
        "zone",
        month["month_start"].alias("month_start"),
        *[c for c in rows.columns if c not in ("zone", "at")],
        *[month[c].alias(c) for c in ("month_num", "year_num", "year_month")],
    )


def _months(zone: str, month: str):
    return Window.partitionBy(zone).orderBy(month)


def trailing_sum(x: Column, k: int, zone: str = "zone", month: str = "month_start") -> Column:
    """Sum of the k months before this one; NULL until there are k."""
    frame = _months(zone, month).rowsBetween(-k, -1)
    return F.when(F.count(x).over(frame) == k, F.sum(x).over(frame))


def cumulative_before(x: Column, zone: str = "zone", month: str = "month_start") -> Column:
    frame = _months(zone, month).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(x).over(frame), F.lit(0.0))


def forward_sum(x: Column, k: int = HORIZON, zone: str = "zone", month: str = "month_start") -> Column:
    """Sum of the next k months; NULL unless all k follow."""
    frame = _months(zone, month).rowsBetween(1, k)
    return F.when(F.count(x).over(frame) == k, F.sum(x).over(frame))


def trailing_incl_next(
    x: Column, k: int = HORIZON, zone: str = "zone", month: str = "month_start"
) -> Column:
    """Sum of the k months that end with the next one; NULL for the first k - 1 rows and the last."""
    months = _months(zone, month)
    frame = months.rowsBetween(-(k - 2), 1)
    usable = (F.row_number().over(months) >= k) & F.lead(x, 1).over(months).isNotNull()
    return F.when(usable, F.sum(x).over(frame))


def add_temporal_features(panel: DataFrame) -> DataFrame:
    """Lags, cumulative count, both targets and month labels; one sort per zone serves all frames."""
    x = F.col("new_ports")
    lags = {f"ports_lag_{k}m": trailing_sum(x, k) for k in LAG_MONTHS}
    return panel.select(
        "*",
        F.lag(x, 1).over(_months("zone", "month_start")).alias("ports_lag_1m"),
        *[c.alias(n) for n, c in lags.items()],
        cumulative_before(x).alias("ports_cum_to_date"),
        forward_sum(x).alias("ports_next_12m"),
        trailing_incl_next(x).alias("ports_trailing_incl_next_12m"),
        F.month("month_start").alias("month_num"),
        F.year("month_start").alias("year_num"),
        fx.month_label(F.col("month_start")).alias("year_month"),
    )


def mark_test_period(panel: DataFrame, months: int = 12) -> DataFrame:
    """True for the months after (latest month - ``months``)."""
    latest = panel.agg(F.max("month_start")).scalar()
    return panel.withColumn("is_test_period", F.col("month_start") > F.add_months(latest, -months))


def latest_per_key(df: DataFrame, key: str, order: str, keep: list[str]) -> DataFrame:
    """The last row of each key; folds before the shuffle."""
    packed = F.struct(F.col(order), *keep)
    last = df.groupBy(key).agg(F.max(packed).alias("_row"))
    return last.select(key, *[F.col(f"_row.{c}").alias(c) for c in [order, *keep]])
