"""Segment rules as versions in time and as rectangles in the plane of days and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.scd2 import FAR_FUTURE
from ledgerloom.operators.segments import AT_RISK, MOST_RULES, NEW, bounded_rules
from ledgerloom.sources.schemas import UNCLASSIFIED_SEGMENT

_FIELDS = ("SegmentKey", "SegmentCode", "RecencyMin", "RecencyMax", "FrequencyMin", "FrequencyMax")


def rule_set_versions(rules: DataFrame) -> DataFrame:
    """The rule sets in force one after another: ``FromDate, ToDate, Rules`` (by key), open at the end.

    Every day on which a rule begins, or the day after one ends, starts a new set. A rule
    without a start has always been in force, one without an end still is. There are at most
    two sets a rule and one more, and rules are bounded (see ``bounded_rules``).
    """
    active = rules.where("IsActive")
    bounded_rules(active)
    begin = F.coalesce("StartDate", F.lit("0001-01-01").cast("date"))
    end = F.coalesce("EndDate", F.lit(FAR_FUTURE))
    held = active.select(*_FIELDS, begin.alias("_begin"), end.alias("_end"))
    borders = F.array(F.col("_begin"), F.when(F.col("_end") < F.lit(FAR_FUTURE), F.date_add("_end", 1)))
    starts = held.select(F.explode(F.array_compact(borders)).alias("FromDate")).distinct()
    following = F.lead("FromDate").over(Window.orderBy("FromDate"))  # at most two rows a rule
    sets = starts.withColumn("ToDate", F.coalesce(F.date_sub(following, 1), F.lit(FAR_FUTURE)))
    in_force = sets.join(F.broadcast(held), F.col("FromDate").between(F.col("_begin"), F.col("_end")), "left")
    fields = F.when(F.col("SegmentKey").isNotNull(), F.struct(*_FIELDS))
    return in_force.groupBy("FromDate", "ToDate").agg(F.sort_array(F.collect_list(fields)).alias("Rules"))


def rules_by_month(months: DataFrame, rules: DataFrame) -> DataFrame:
    """``MonthEndDate, Rules``: each month end with the rule set in force on it, none before the first set."""
    sets = rule_set_versions(rules)
    inside = F.col("MonthEndDate").between(F.col("FromDate"), F.col("ToDate"))
    return months.select("MonthEndDate").distinct().join(F.broadcast(sets), inside, "left").select("MonthEndDate", "Rules")


def assign_segment_as_of(scored: DataFrame, rules: DataFrame, months: DataFrame, mode: str = "as_coded") -> DataFrame:
    """:func:`~ledgerloom.operators.segments.assign_segment` by the rules in force at the end of each month.

    ``months`` has the ``MonthEndDate`` of the calendar. Every month carries its rule set, so
    the rows meet a table with one row a month, and rules are tried within the row.
    """
    if mode not in ("as_coded", "range"):
        raise ValueError(f"unknown mode {mode!r}")
    days, count, earlier = F.col("DaysSinceLastTransaction"), F.col("TransactionCount"), F.col("PreviousMonthTransactionCount")

    def first(test) -> Column:
        return F.try_element_at(F.filter("_rules", test), F.lit(1))["SegmentKey"]

    in_days = lambda r: days.between(r["RecencyMin"], r["RecencyMax"])
    in_band = lambda r: in_days(r) & count.between(r["FrequencyMin"], r["FrequencyMax"])
    of_month = rules_by_month(months, rules).withColumnRenamed("Rules", "_rules")
    # one row a month of the calendar
    rows = scored.join(F.broadcast(of_month), "MonthEndDate", "left")
    if mode == "range":
        steps = [("Range", first(in_band))]
    else:
        steps = [
            ("AtRisk", first(lambda r: (r["SegmentCode"] == AT_RISK) & in_days(r) & (earlier >= r["FrequencyMin"]))),
            ("New", F.when(F.col("IsFirstMonth"), first(lambda r: r["SegmentCode"] == NEW))),
            ("Range", first(lambda r: (r["SegmentCode"] != AT_RISK) & in_band(r))),
        ]
    step = F.lit(None).cast("string")
    for name, key in reversed(steps):
        step = F.when(key.isNotNull(), name).otherwise(step)
    key = F.coalesce(*[k for _, k in steps], F.lit(UNCLASSIFIED_SEGMENT))
    return rows.withColumns({"SegmentKey": key, "SegmentStep": step}).select(*scored.columns, "SegmentKey", "SegmentStep")


def rule_faults(
    rules: DataFrame,
    across: tuple[str, str] = ("RecencyMin", "RecencyMax"),
    along: tuple[str, str] = ("FrequencyMin", "FrequencyMax"),
    name: str = "SegmentCode",
    steps: tuple[str, str] = ("1", "1"),
    kind: str = "int",
) -> DataFrame:
    """Every gap and overlap of rules that are rectangles, as rectangles: no data is needed.

    A rule holds the values from its lower to its upper border, both included; a NULL border
    is open. The plane begins at 0 on both axes and has no end. ``steps`` is the distance of
    neighbouring values (1, or 0.01 for money) and ``kind`` the type of the borders. Columns:
    ``XFrom, XTo, YFrom, YTo`` (NULL where open), ``Rules`` (how many hold the rectangle: 0 or
    2 and more) and ``Names`` (theirs, sorted, comma-joined).

    The borders cut each axis into stretches; a rule covers whole ones. A sweep along each
    strip joins neighbours of equal rules, a second one across joins equal stretches of
    neighbouring strips. There are at most twice as many stretches as rules on an axis.
    """
    wide = "decimal(38,4)" if kind != "int" else "bigint"
    (x_low, x_high), (y_low, y_high) = across, along
    step_x, step_y = (F.lit(s).cast(wide) for s in steps)
    least = F.lit(0).cast(wide)
    held = rules.select(
        F.col(name).alias("name"),
        F.greatest(F.coalesce(F.col(x_low).cast(wide), least), least).alias("x0"),
        (F.col(x_high).cast(wide) + step_x).alias("x1"),
        F.greatest(F.coalesce(F.col(y_low).cast(wide), least), least).alias("y0"),
        (F.col(y_high).cast(wide) + step_y).alias("y1"),
    )

    def cuts(low: str, high: str) -> Column:
        every = F.concat(F.array(least), F.flatten(F.collect_set(F.array_compact(F.array(low, high)))))
        return F.array_sort(F.array_distinct(F.filter(every, lambda v: v >= least)))

    if rules.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")

    def stretches(df: DataFrame, cut: str, place: str, step: Column) -> DataFrame:
        """One row for each stretch of an axis: its number, first and last value."""
        others = [c for c in df.columns if c != cut]
        first, last = f"{place}_from", f"{place}_to"
        each = df.select(*others, cut, F.posexplode(cut).alias(place, first))
        following = F.try_element_at(cut, (F.col(place) + 2).cast("int"))
        return each.select(*others, place, first, (following - step).alias(last))

    # one row that holds all borders, two a rule on each axis, opens into cells
    axes = held.agg(cuts("x0", "x1").alias("xs"), cuts("y0", "y1").alias("ys"))
    cells = stretches(stretches(axes, "xs", "i", step_x), "ys", "j", step_y)
    covers = (
        (F.col("i_from") >= F.col("x0"))
        & (F.col("x1").isNull() | (F.col("i_from") < F.col("x1")))
        & (F.col("j_from") >= F.col("y0"))
        & (F.col("y1").isNull() | (F.col("j_from") < F.col("y1")))
    )
    # a cell meets the rules that hold its lower corner
    found = cells.join(F.broadcast(held), covers, "left").groupBy(*cells.columns).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("name"))).alias("Names"), F.count("name").cast("int").alias("Rules")
    )

    def run(part: list[str], place: str) -> Column:
        """Neighbouring places of equal ``part`` have one number."""
        return F.col(place) - F.row_number().over(Window.partitionBy(*part).orderBy(place))

    strip, kinds = ["i", "i_from", "i_to"], ["Names", "Rules"]
    along_strip = (
        found.where(F.col("Rules") != 1)
        .withColumn("_run", run([*strip, *kinds], "j"))
        .groupBy(*strip, *kinds, "_run")
        .agg(F.min("j").alias("j0"), F.max("j").alias("j1"), F.min("j_from").alias("YFrom"), F.max_by("j_to", "j").alias("YTo"))
    )
    both = [*kinds, "j0", "j1", "YFrom", "YTo"]
    whole = (
        along_strip.withColumn("_across", run(both, "i"))
        .groupBy(*both, "_across")
        .agg(F.min("i_from").alias("XFrom"), F.max_by("i_to", "i").alias("XTo"))
    )
    return whole.select("XFrom", "XTo", "YFrom", "YTo", "Rules", "Names")


def faulty_points(points: DataFrame, faults: DataFrame, x: str = "DaysSinceLastTransaction", y: str = "TransactionCount") -> DataFrame:
    """``faults`` with ``Points``: how many rows of ``points`` lie in each rectangle, 0 included.

    Rows are counted by point before they meet the rectangles, of which there are few.
    """
    counted = points.groupBy(x, y).agg(F.count(F.lit(1)).alias("_n"))
    inside = (
        (F.col(x) >= F.col("XFrom"))
        & (F.col("XTo").isNull() | (F.col(x) <= F.col("XTo")))
        & (F.col(y) >= F.col("YFrom"))
        & (F.col("YTo").isNull() | (F.col(y) <= F.col("YTo")))
    )
    columns = faults.columns
    hit = counted.join(F.broadcast(faults), inside).groupBy(*columns).agg(F.sum("_n").alias("Points"))
    none = faults.withColumn("Points", F.lit(0).cast("long"))
    return hit.unionByName(none).groupBy(*columns).agg(F.max("Points").alias("Points"))
