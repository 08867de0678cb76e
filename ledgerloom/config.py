"""One settings object for the whole warehouse build."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, got {value!r}")


@dataclass(frozen=True)
class Settings:
    """Dates, policies and the seed of the scored columns.

    start / cutoff      first day and last day the monthly snapshot may cover
    calendar_start/end  range of the date dimension
    as_of               "today" for ages and relative date flags
    scd_join            "version_key": a transaction belongs to the customer version of
                        its own location; "date_range": to every version whose date
                        window holds the transaction date (may multiply rows)
    segment_mode        "as_coded": At Risk, then New, then the bands; "range": bands only
    dob_policy          "null_out_of_range" or "default_1900"
    age_mode            "documented" (56 and above is 56+) or "as_coded" (56 is Unknown)
    customer_type_mode  "as_coded" (always Existing) or "documented" (New for 90 days)
    balance_carry       "running_max" or "last_value"
    rule_validity       "ignore": all active segment rules hold at all times; "as_of": those
                        whose StartDate and EndDate hold the end of the month
    grain               "version": only the current customer version feeds the snapshot;
                        "customer_id": the whole history of the customer does
    """

    start: date = date(2015, 1, 1)
    cutoff: date = date(2016, 8, 31)
    calendar_start: date = date(2015, 1, 1)
    calendar_end: date = date(2030, 12, 31)
    as_of: date = date(2016, 8, 31)
    seed: int = 42
    scd_join: str = "version_key"
    segment_mode: str = "as_coded"
    dob_policy: str = "null_out_of_range"
    age_mode: str = "documented"
    customer_type_mode: str = "as_coded"
    balance_carry: str = "running_max"
    rule_validity: str = "ignore"
    grain: str = "version"

    def __post_init__(self) -> None:
        _one_of("scd_join", self.scd_join, ("version_key", "date_range"))
        _one_of("segment_mode", self.segment_mode, ("as_coded", "range"))
        _one_of("dob_policy", self.dob_policy, ("null_out_of_range", "default_1900"))
        _one_of("age_mode", self.age_mode, ("documented", "as_coded"))
        _one_of("customer_type_mode", self.customer_type_mode, ("as_coded", "documented"))
        _one_of("balance_carry", self.balance_carry, ("running_max", "last_value"))
        _one_of("rule_validity", self.rule_validity, ("ignore", "as_of"))
        _one_of("grain", self.grain, ("version", "customer_id"))
        if self.start > self.cutoff:
            raise ValueError("start lies after cutoff")
        if self.calendar_start > self.calendar_end:
            raise ValueError("calendar_start lies after calendar_end")
