"""Joins to, and incremental maintenance of, a Type 2 dimension."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import location_code
from ledgerloom.operators.keys import with_surrogate_key
from ledgerloom.operators.skew import balanced_join
from ledgerloom.sources.workspace import cut_lineage

FAR_FUTURE = date(9999, 12, 31)


def scd2_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    date_col: str,
    mode: str = "version_key",
    version: str = "LocationMatch",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join facts to dimension versions.

    ``version_key``: equal key and equal version attribute. A customer who came back has
    several versions with one attribute; the one whose window holds the date is taken, and
    the last of them where none does, so a fact meets one version at most.
    ``date_range``: equal key and a date within [StartDate, EndDate], open where EndDate
    is NULL; a fact meets every version that fits. ``versions`` carries ``DatedRows``,
    the number of facts behind each version, from which hot keys are found without
    another pass over the facts.
    """
    spread_by = spread_by or [date_col]
    counts = versions.select(key, *([version] if mode == "version_key" else []), "DatedRows")
    small = versions.drop("DatedRows")
    if mode == "version_key":
        others = [c for c in small.columns if c not in (key, version)]
        fields = ["StartDate", *[c for c in others if c != "StartDate"]]
        of_key = small.groupBy(key, version).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_versions"))
        joined = balanced_join(facts, of_key, [key, version], counts, "DatedRows", spread_by)
        holds = lambda v: F.col(date_col).between(v["StartDate"], F.coalesce(v["EndDate"], F.lit(FAR_FUTURE)))
        fitting = F.try_element_at(F.filter("_versions", holds), F.lit(-1))
        picked = joined.withColumn("_version", F.coalesce(fitting, F.element_at("_versions", -1)))
        return picked.select(*[c for c in joined.columns if c != "_versions"], *[f"_version.{c}" for c in others])
    if mode == "date_range":
        inside = F.col(date_col).between(F.col("StartDate"), F.coalesce("EndDate", F.lit(FAR_FUTURE)))
        return balanced_join(facts, small, [key], counts, "DatedRows", spread_by, condition=inside)
    raise ValueError(f"unknown mode {mode!r}")


def window_difference(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Days that the version windows of ``new`` hold and those of ``old`` do not, and the other way round.

    Both have ``key`` (unique), ``StartDate`` and ``EndDate`` (open where NULL). One row for
    each stretch of days: ``key, StartDate, EndDate, Gained``. A window that grew at both ends
    has two; equal windows have none. One join of the two, by ``key``.
    """
    window = lambda df, name: df.select(
        key, F.struct("StartDate", F.coalesce("EndDate", F.lit(FAR_FUTURE)).alias("EndDate")).alias(name)
    )
    both = window(old, "_o").join(window(new, "_n"), key, "full_outer")

    def apart(one: str, other: str, gained: bool) -> list:
        """The part of ``one`` before ``other`` begins and the part after it ends; all of it if there is no other."""
        before = F.least(f"{one}.EndDate", F.coalesce(F.date_sub(f"{other}.StartDate", 1), f"{one}.EndDate"))
        after = F.greatest(f"{one}.StartDate", F.date_add(f"{other}.EndDate", 1))
        whole = F.col(other).isNull()
        stretch = lambda a, b: F.struct(a.alias("StartDate"), b.alias("EndDate"), F.lit(gained).alias("Gained"))
        later = F.when(whole | (F.col(f"{other}.EndDate") == F.lit(FAR_FUTURE)), F.lit(None)).otherwise(after)
        return [stretch(F.col(f"{one}.StartDate"), before), stretch(later, F.col(f"{one}.EndDate"))]

    stretches = F.filter(
        F.array(*apart("_n", "_o", True), *apart("_o", "_n", False)), lambda s: s["StartDate"] <= s["EndDate"]
    )
    return both.select(key, F.explode(stretches).alias("s")).select(key, "s.*")


def window_gains(old: DataFrame, new: DataFrame, customers: DataFrame) -> DataFrame:
    """Stretches of days that versions of ``customers`` have come to hold, as windows to join facts with.

    ``old`` and ``new`` are two states of the customer dimension in which versions keep their
    keys. The result has what :func:`scd2_join` reads: ``CustomerID, CustomerKey, StartDate,
    EndDate, DatedRows``, the last with all facts behind the customer in ``old``.
    """
    touched = customers.where(F.col("CustomerID").isNotNull()).distinct()
    was, now = (d.join(touched, "CustomerID", "left_semi") for d in (old, new))
    gained = window_difference(was, now, "CustomerKey").where("Gained").drop("Gained")
    owners = now.select("CustomerKey", "CustomerID")
    rows = was.groupBy("CustomerID").agg(F.sum("DatedRows").alias("DatedRows"))
    return gained.join(owners, "CustomerKey").join(rows, "CustomerID").select(
        "CustomerID", "CustomerKey", "StartDate", "EndDate", "DatedRows"
    )


def scd2_merge(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: list[str],
    type1: list[str],
    eff_date: date,
    surrogate: str | None = None,
) -> DataFrame:
    """Apply one batch of changes to a Type 2 dimension.

    A changed tracked column closes the current row the day before ``eff_date`` and opens
    a new one; a new key opens its first row; columns in ``type1`` are overwritten on the
    current row. Closed rows stay as they are. ``updates`` has one row per key: a second
    one raises an error, as does an ``eff_date`` on or before the start of a row that it
    would close. One join of the current rows with the updates makes all of this. New rows
    have NULL in columns that the updates do not carry, and the next free numbers as
    ``surrogate``.
    """
    twice = updates.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} {twice[0][0]!r} has several rows in one batch")
    columns = current.columns
    closed = current.where(~F.col("IsCurrent"))
    old = current.where("IsCurrent").select(F.struct(*columns).alias("o"), F.col(key).alias("_key"))
    new = updates.select(F.struct(*updates.columns).alias("n"), F.col(key).alias("_key"))
    both = old.join(new, "_key", "full_outer")

    moved = F.lit(False)
    for name in tracked:
        moved = moved | ~F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    is_new, is_gone = F.col("o").isNull(), F.col("n").isNull()

    def row(pick):
        fields = [pick(f.name).cast(f.dataType).alias(f.name) for f in current.schema.fields]
        return F.struct(*fields)

    def opened(name):
        fixed = {"StartDate": F.lit(eff_date), "EndDate": F.lit(None), "IsCurrent": F.lit(True)}
        if name in fixed:
            return fixed[name]
        return F.col(f"n.{name}") if name in updates.columns else F.lit(None)

    def shut(name):
        early = F.concat(F.lit(f"{eff_date} is not after the start of the current row of "), F.col("_key").cast("string"))
        end = F.when(F.col("o.StartDate") >= F.lit(eff_date), F.raise_error(early)).otherwise(F.date_sub(F.lit(eff_date), 1))
        fixed = {"EndDate": end, "IsCurrent": F.lit(False)}
        return fixed.get(name, F.col(f"o.{name}"))

    def kept(name):
        if name in type1:
            return F.when(is_gone, F.col(f"o.{name}")).otherwise(F.col(f"n.{name}"))
        return F.col(f"o.{name}")

    rows = (
        F.when(is_new, F.array(row(opened)))
        .when(~is_gone & moved, F.array(row(shut), row(opened)))
        .otherwise(F.array(row(kept)))
    )
    merged = both.select(F.explode(rows).alias("r")).select("r.*").unionByName(closed)
    if surrogate is None:
        return merged
    last = current.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    # written once: the join then runs once, and the keys read the opened rows from files
    merged = cut_lineage(merged, f"scd2-merge-{uuid.uuid4().hex}")
    fresh = merged.where(F.col(surrogate).isNull()).drop(surrogate)
    numbered = with_surrogate_key(fresh, surrogate, [key, "StartDate"])
    shifted = numbered.withColumn(surrogate, (F.col(surrogate) + F.lit(last)).cast(merged.schema[surrogate].dataType))
    return merged.where(F.col(surrogate).isNotNull()).unionByName(shifted)


def merge_customers(
    current: DataFrame, updates: DataFrame, dim_location: DataFrame, eff_date: date, counts: DataFrame | None = None
) -> DataFrame:
    """:func:`scd2_merge` of the customer dimension, with all columns of opened rows filled.

    ``updates`` has CustomerID, Location and any of the descriptive columns, which are
    overwritten on the current row; those it lacks keep the customer's last values. The
    location key, the name to match by, the first dates and the load stamps follow from
    these. ``counts`` (CustomerID, DatedRows) tells how many transactions of the batch stand
    behind a customer, for finding hot keys later.
    """
    described = [c for c in ("DateOfBirth", "Age", "AgeGroup", "Gender", "CustomerType") if c in current.columns]
    given = [c for c in described if c in updates.columns]
    places = dim_location.select("LocationKey", F.col("LocationCode").alias("_code"))
    known = current.where("IsCurrent").select(
        "CustomerID", "FirstTransactionDateEver", *[F.col(c).alias(f"_old_{c}") for c in described]
    )
    full = (
        updates.select("CustomerID", "Location", *given)
        .withColumn("_code", location_code(F.col("Location")))
        .join(places, "_code", "left")
        .join(known, "CustomerID", "left")
    )
    if counts is not None:
        full = full.join(counts.select("CustomerID", "DatedRows"), "CustomerID", "left")
    else:
        full = full.withColumn("DatedRows", F.lit(None).cast("long"))
    start = F.lit(eff_date).cast("date")
    filled = full.select(
        "CustomerID",
        "Location",
        *[(F.coalesce(c, f"_old_{c}") if c in given else F.col(f"_old_{c}")).alias(c) for c in described],
        F.upper("Location").alias("LocationMatch"),
        "LocationKey",
        start.alias("FirstTransactionDate"),
        F.coalesce("FirstTransactionDateEver", start).alias("FirstTransactionDateEver"),
        F.coalesce("DatedRows", F.lit(0)).alias("DatedRows"),
        F.current_timestamp().alias("CreatedDate"),
        F.current_timestamp().alias("ModifiedDate"),
    )
    return scd2_merge(current, filled, "CustomerID", ["LocationMatch"], described, eff_date, surrogate="CustomerKey")


def scd_version_counts(dim_customer: DataFrame, more_than: int = 1) -> DataFrame:
    """Customers with more than ``more_than`` versions."""
    counts = dim_customer.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("VersionCount"))
    return counts.where(F.col("VersionCount") > more_than)


def scd_version_histogram(dim_customer: DataFrame) -> DataFrame:
    """How many customers have one version, two, and so on."""
    return (
        scd_version_counts(dim_customer, more_than=0)
        .groupBy("VersionCount")
        .agg(F.count(F.lit(1)).alias("Customers"))
    )
