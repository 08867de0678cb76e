"""Questions about the same customer in two months: migration, conversion, streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.plans.measures import Where, _split, _test
from ledgerloom.plans.model import CUSTOMER_ATTRIBUTES, LOCATION_ATTRIBUTES, Model

PERIODS = ("month", "quarter", "year")


def _counted(
    model: Model, rows: DataFrame, counts: dict[str, Column], keys: list[str], by: list[str], where: Where
) -> DataFrame:
    """Count rows with a CustomerKey by customer and location attributes.

    Rows are counted by location key before the location names join, so a place that
    holds many customers is a few rows by then.
    """
    names = set(by) | set(where)
    unknown = names - set(CUSTOMER_ATTRIBUTES) - set(LOCATION_ATTRIBUTES)
    if unknown:
        raise ValueError(f"not attributes of a customer: {sorted(unknown)}")
    places, people = sorted(names & set(LOCATION_ATTRIBUTES)), sorted(names & set(CUSTOMER_ATTRIBUTES))
    picked = people + (["LocationKey"] if places else [])
    if picked:
        rows = rows.join(model.dim_customer.select("CustomerKey", *picked), "CustomerKey", "left")
    counted = rows.groupBy(*keys, *picked).agg(*[column.alias(name) for name, column in counts.items()])
    if places:
        counted = counted.join(model.dim_location.select("LocationKey", *places), "LocationKey", "left")
    for name, value in where.items():
        counted = counted.where(_test(value, F.col(name)))
    none = F.lit(0).cast("bigint")
    return counted.groupBy(*keys, *by).agg(*[F.coalesce(F.sum(name), none).alias(name) for name in counts])


def _period_start(model: Model, period: str) -> int | None:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    a = model.anchors()
    return {"month": a.previous, "quarter": a.quarter, "year": a.year}[period]


def segment_pairs(model: Model, period: str) -> DataFrame:
    """Segment of each customer at the start and the end of the period, customers in both.

    One pass over two months and one aggregation by customer, in place of a self-join.
    """
    last, start = model.anchors().last, _period_start(model, period)
    two = model.snapshot.where(F.col("DateKey").isin(*[k for k in (last, start) if k is not None]))

    def segment_at(key: int | None) -> Column:
        return F.max(F.when(F.col("DateKey") == F.lit(key), F.col("SegmentKey")))

    return (
        two.groupBy("CustomerKey")
        .agg(segment_at(start).alias("FromSegment"), segment_at(last).alias("ToSegment"))
        .where(F.col("FromSegment").isNotNull() & F.col("ToSegment").isNotNull())
    )


def segment_migration(
    model: Model, period: str, by: list[str] | None = None, where: Where | None = None
) -> DataFrame:
    """Customers whose segment differs between the two ends of the period; NULL if none."""
    moved = segment_pairs(model, period).where(F.col("FromSegment") != F.col("ToSegment"))
    name = f"segment_migration_{period}"
    by = list(by or [])
    counted = _counted(model, moved, {name: F.count(F.lit(1))}, [], by, where or {})
    return counted.withColumn(name, F.nullif(F.col(name), F.lit(0)))


def segment_flow(model: Model, period: str) -> DataFrame:
    """Customers per pair of segments, those who stayed included."""
    names = model.dim_segment.select("SegmentKey", "SegmentName")
    counts = segment_pairs(model, period).groupBy("FromSegment", "ToSegment").agg(F.count(F.lit(1)).alias("Customers"))
    start = names.withColumnsRenamed({"SegmentKey": "FromSegment", "SegmentName": "FromName"})
    end = names.withColumnsRenamed({"SegmentKey": "ToSegment", "SegmentName": "ToName"})
    return (
        counts.join(start, "FromSegment", "left").join(end, "ToSegment", "left").select("FromName", "ToName", "Customers")
    )


def _next_months(model: Model, months: list[int] | None = None) -> DataFrame:
    """Snapshot rows beside the row of the same customer in the next month of the data.

    A window by customer over the few columns that transitions need; ``months`` cuts the
    scan to the months in question.
    """
    keys = [m["DateKey"] for m in model.months]
    following = {a: b for a, b in zip(keys, keys[1:])}
    rows = model.snapshot if months is None else model.snapshot.where(F.col("DateKey").isin(*months))
    narrow = rows.select(
        "CustomerKey",
        "DateKey",
        "SegmentKey",
        (F.col("TrendCategory") == "New").alias("IsNew"),
        (~F.col("ChurnFlag") & ~F.col("AtRiskFlag")).alias("IsActive"),
        (F.col("TransactionCount") > 0).alias("Transacts"),
    )
    by_month = Window.partitionBy("CustomerKey").orderBy("DateKey")
    expected = F.lit(None).cast("int")
    if following:
        pairs = [F.lit(x) for pair in following.items() for x in pair]
        expected = F.try_element_at(F.create_map(*pairs), F.col("DateKey"))  # one entry a month
    is_next = F.lead("DateKey").over(by_month) == expected
    later = {
        f"Next{name}": F.when(is_next, F.lead(name).over(by_month)) for name in ("SegmentKey", "IsActive", "Transacts")
    }
    return narrow.withColumn("HasNextMonth", expected.isNotNull()).withColumns(later)


def _transition_counts(model: Model) -> dict[str, Column]:
    key = model.segment_keys

    def rows(test: Column) -> Column:
        return F.count_if(F.coalesce(test, F.lit(False)))

    def in_segment(code: str, column: str = "SegmentKey") -> Column:
        return F.col(column) == key.get(code)

    return {
        "NewCustomers": rows(F.col("IsNew")),
        "NewRetained": rows(F.col("IsNew") & F.col("NextIsActive")),
        "PotentialLoyalists": rows(in_segment("RF_Potential")),
        "LoyalConversions": rows(in_segment("RF_Potential") & in_segment("RF_Loyal", "NextSegmentKey")),
        "HibernatingCustomers": rows(in_segment("RF_Hibernating")),
        "WonBack": rows(in_segment("RF_Hibernating") & F.col("NextTransacts")),
    }


def _rate(part: str, whole: str, name: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")).alias(name)


_RATES = (
    ("NewRetained", "NewCustomers", "NewCustomerRetentionRate"),
    ("LoyalConversions", "PotentialLoyalists", "LoyalConversionRate"),
    ("WonBack", "HibernatingCustomers", "WinBackRate"),
)


def transitions(model: Model, by: list[str] | None = None, per_month: bool = False, where: Where | None = None) -> DataFrame:
    """Retention of new customers, conversion of potential to loyal ones, and win-back.

    The cohort is a month's customers and the outcome is their state one month later.
    By default the cohort is the month before the last; ``per_month`` gives one row for
    every month that has a next one.
    """
    by = list(by or [])
    chosen = _split(model, where)
    if chosen.segment:
        raise ValueError("transitions go between segments and cannot be filtered by one")
    if per_month:
        rows = _next_months(model).where("HasNextMonth")
        if len(chosen.months) < len(model.months):
            rows = rows.where(F.col("DateKey").isin(*chosen.months) if chosen.months else F.lit(False))
        keys = ["DateKey"]
    else:
        a = model.anchors(chosen.months)
        two = [k for k in (a.previous, a.last) if k is not None]
        rows = _next_months(model, two).where(F.col("DateKey") == F.lit(a.previous))
        keys = []
    counted = _counted(model, rows, _transition_counts(model), keys, by, chosen.other)
    return counted.select("*", *[_rate(*names) for names in _RATES])


def loyalty_funnel(model: Model, where: Where | None = None) -> DataFrame:
    """Stages of the funnel for the month before the last: New, Potential, converted to Loyal."""
    stages = [("New", "NewCustomers"), ("Potential Loyalists", "PotentialLoyalists"), ("Converted to Loyal", "LoyalConversions")]
    rows = [
        F.struct(
            F.lit(i).alias("StageOrder"), F.lit(stage).alias("Stage"), F.col(column).alias("Customers")
        )
        for i, (stage, column) in enumerate(stages, start=1)
    ]
    return transitions(model, where=where).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def converted_customers(model: Model) -> DataFrame:
    """Customers Potential in the month before the last and Loyal in the last: two key sets
    and what they share."""
    a, key = model.anchors(), model.segment_keys

    def members(month: int | None, code: str) -> DataFrame:
        test = (F.col("DateKey") == F.lit(month)) & (F.col("SegmentKey") == key.get(code))
        return model.snapshot.where(test).select("CustomerKey")

    both = members(a.previous, "RF_Potential").intersect(members(a.last, "RF_Loyal"))
    return both.join(model.dim_customer.select("CustomerKey", "CustomerID"), "CustomerKey").select("CustomerID")


def declining_streaks(model: Model, carried: list[str] | None = None) -> DataFrame:
    """Length of the run of falling growth rates that ends at each customer-month.

    A month falls if its growth rate is below that of the calendar month before. Runs are
    numbered by counting the months that do not fall; a run never spans such a month.
    ``carried`` names further columns of the snapshot to keep; the calendar is cut to the
    months of the snapshot before it is broadcast.
    """
    carried = list(carried or [])
    by_month = Window.partitionBy("CustomerKey").orderBy("DateKey")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = [m["DateKey"] for m in model.months]
    month_number = (F.col("Year") * 12 + F.col("Month")).alias("_month")
    months = model.dim_date.where(F.col("DateKey").isin(*known) if known else F.lit(False)).select("DateKey", month_number)
    kept = ["CustomerKey", "DateKey", *dict.fromkeys(["GrowthRate", *carried])]
    rows = model.snapshot.select(*kept).join(F.broadcast(months), "DateKey")
    adjacent = F.col("_month") - F.lag("_month").over(by_month) == 1
    falls = F.coalesce(adjacent & (F.col("GrowthRate") < F.lag("GrowthRate").over(by_month)), F.lit(False))
    marked = rows.withColumn("_falls", falls)
    runs = marked.withColumn("_run", F.sum((~F.col("_falls")).cast("int")).over(so_far))
    within = Window.partitionBy("CustomerKey", "_run").orderBy("DateKey")
    length = F.sum(F.col("_falls").cast("int")).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return runs.select("CustomerKey", "DateKey", *carried, length.alias("DecliningMonths"))


def declining_streak(model: Model, k: int = 2) -> DataFrame:
    """Customers whose growth rate has fallen for at least ``k`` months up to the last month."""
    last = model.anchors().last
    at_last = declining_streaks(model).where((F.col("DateKey") == F.lit(last)) & (F.col("DecliningMonths") >= k))
    return at_last.join(model.dim_customer.select("CustomerKey", "CustomerID"), "CustomerKey").select(
        "CustomerID", F.col("DecliningMonths").cast("bigint").alias("DecliningMonths")
    )


def at_risk_customers(model: Model, k: int = 2) -> DataFrame:
    """Customers of the last month who are flagged at risk or whose growth keeps falling."""
    last = model.anchors().last
    # the streak's window carries the last month's own columns along
    streaks = declining_streaks(model, ["AtRiskFlag", "DaysSinceLastTransaction", "GrowthRate"])
    now = streaks.where(F.col("DateKey") == F.lit(last)).drop("DateKey")
    listed = now.where(F.col("AtRiskFlag") | (F.col("DecliningMonths") >= k))
    return listed.join(model.dim_customer.select("CustomerKey", "CustomerID"), "CustomerKey").select(
        "CustomerID",
        "AtRiskFlag",
        "DaysSinceLastTransaction",
        "GrowthRate",
        F.col("DecliningMonths").cast("bigint").alias("DecliningMonths"),
    )


def churn_profile(model: Model) -> DataFrame:
    """What churned, hibernating and other customers of the last month have in common.

    Satisfaction now; complaints at any time; and whether the customer's last month with
    transactions already showed falling growth. One aggregation by customer feeds it.
    """
    last = model.anchors().last
    at_last = F.col("DateKey") == F.lit(last)
    history = model.snapshot.groupBy("CustomerKey").agg(
        F.max(F.when(at_last, F.col("SegmentKey"))).alias("SegmentKey"),
        F.max(F.when(at_last, F.col("ChurnFlag"))).alias("ChurnFlag"),
        F.max(F.when(at_last, F.col("SatisfactionScore"))).alias("SatisfactionScore"),
        F.max("ComplaintFlag").alias("EverComplained"),
        F.max_by(
            F.when(F.col("TransactionCount") > 0, F.coalesce(F.col("GrowthRate") < 0, F.lit(False))),
            F.when(F.col("TransactionCount") > 0, F.col("DateKey")),
        ).alias("FellBeforeSilence"),
    )
    status = (
        F.when(F.col("ChurnFlag"), "Churned")
        .when(F.col("SegmentKey") == model.segment_keys.get("RF_Hibernating"), "Hibernating")
        .otherwise("Other")
    )
    return (
        history.where(F.col("ChurnFlag").isNotNull())
        .groupBy(status.alias("Status"))
        .agg(
            F.count(F.lit(1)).alias("Customers"),
            F.avg("SatisfactionScore").cast("decimal(7,6)").alias("AvgSatisfaction"),
            F.count_if(F.col("SatisfactionScore") <= 2).alias("LowSatisfaction"),
            F.count_if("EverComplained").alias("EverComplained"),
            F.count_if(F.coalesce("FellBeforeSilence", F.lit(False))).alias("FellBeforeSilence"),
        )
    )


def growth_distribution(model: Model) -> DataFrame:
    """Customers of the last month by trend category, with percent of customers."""
    from ledgerloom.operators.reports import distribution

    now = model.snapshot.where(F.col("DateKey") == F.lit(model.anchors().last))
    return distribution(now, "TrendCategory", count="Customers")


#: The stages of the loyalty path in order, by segment code.
LOYALTY_STAGES = ("RF_New", "RF_Potential", "RF_Loyal")


def customer_paths(model: Model, stages: tuple[str, ...] = LOYALTY_STAGES, largest_gap: int = 3) -> DataFrame:
    """How far each customer has come along ``stages``: an automaton folded over the customer's months.

    A customer enters at the first stage and moves on in a month that shows the next one.
    Months of the stage the customer is in keep the path alive; if none of these is seen for
    more than ``largest_gap`` months, the path is lost and may begin anew. Who has come to the
    last stage stays there. Columns: ``CustomerKey, Stage`` (0: not entered; the furthest ever
    reached, by the first path that did), ``Months`` from entry to that stage and
    ``MonthsInStages`` (how many months each stage up to it took).

    Months of one customer are one row a month of the snapshot, gathered in one place.
    """
    key = model.segment_keys
    number = F.lit(None).cast("int")
    for i, code in reversed(list(enumerate(stages, 1))):
        number = F.when(F.col("SegmentKey") == F.lit(key.get(code)), i).otherwise(number)
    month = F.expr("DateKey div 10000 * 12 + DateKey div 100 % 100").cast("int")
    seen = model.snapshot.select("CustomerKey", month.alias("m"), number.alias("s"))
    of_customer = seen.groupBy("CustomerKey").agg(
        F.sort_array(F.collect_list(F.when(F.col("s").isNotNull(), F.struct("m", "s")))).alias("_months")
    )
    nothing = F.struct(
        F.lit(0).alias("stage"),
        F.lit(0).alias("last"),
        F.array().cast("array<int>").alias("entered"),
        F.lit(0).alias("best"),
        F.array().cast("array<int>").alias("best_entered"),
    )

    def step(a: Column, x: Column) -> Column:
        alive = (a["stage"] > 0) & (x["m"] - a["last"] <= largest_gap) | (a["stage"] == len(stages))
        stage = F.when(alive, a["stage"]).otherwise(0)
        onward = x["s"] == stage + 1
        stays = (stage > 0) & (x["s"] == stage)
        entered = F.when(alive, a["entered"]).otherwise(F.array().cast("array<int>"))
        now = F.when(onward, stage + 1).otherwise(stage)
        path = F.when(onward, F.concat(entered, F.array(x["m"]))).otherwise(entered)
        further = now > a["best"]
        return F.struct(
            now.alias("stage"),
            F.when(onward | stays, x["m"]).otherwise(a["last"]).alias("last"),
            path.alias("entered"),
            F.when(further, now).otherwise(a["best"]).alias("best"),
            F.when(further, path).otherwise(a["best_entered"]).alias("best_entered"),
        )

    folded = of_customer.select("CustomerKey", F.aggregate("_months", nothing, step).alias("a"))
    entered = F.col("a.best_entered")
    after_first = F.slice(entered, 2, F.greatest(F.size(entered) - 1, F.lit(0)))
    took = F.transform(after_first, lambda m, i: m - F.element_at(entered, i + 1))
    return folded.select(
        "CustomerKey",
        F.col("a.best").alias("Stage"),
        F.when(F.col("a.best") > 0, F.element_at(entered, -1) - F.element_at(entered, 1)).alias("Months"),
        took.alias("MonthsInStages"),
    )


def loyalty_paths(model: Model, largest_gap: int = 3) -> DataFrame:
    """Customers by the path they have made and the months it took: ``Path, Months, Customers``."""
    paths = [F.lit("none"), *[F.lit(" > ".join(c.removeprefix("RF_") for c in LOYALTY_STAGES[:i])) for i in (1, 2, 3)]]
    path = F.element_at(F.array(*paths), F.col("Stage") + 1)
    return customer_paths(model, LOYALTY_STAGES, largest_gap).groupBy(path.alias("Path"), "Months").agg(
        F.count(F.lit(1)).alias("Customers")
    )
