"""Salary, category and number expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ..scale import col


def lookup(key: Column | str, table: Mapping, default=None) -> Column:
    """Map through a small literal table; unknown keys give `default`."""
    literal = F.create_map(*[F.lit(x) for x in chain(*table.items())])
    found = literal[col(key)]
    return found if default is None else F.coalesce(found, F.lit(default))


def present_mean(low: Column | str, high: Column | str) -> Column:
    """Mean of the bounds that are present."""
    low, high = col(low), col(high)
    return (F.coalesce(low, high) + F.coalesce(high, low)) / 2


def annualise(known: Column | str, low: Column | str, high: Column | str, middle: Column | str,
              period: Column | str) -> Column:
    """The known yearly amount, else the midpoint (or middle) times the period's multiplier."""
    factor = lookup(F.upper(col(period)), K.PAY_PERIOD_TO_ANNUAL)
    return F.coalesce(col(known), F.coalesce(present_mean(low, high), col(middle)) * factor)


def mean_if_both(low: Column | str, high: Column | str) -> Column:
    """The midpoint only when both bounds are present."""
    return (col(low) + col(high)) / 2


def salary_drop_reason(salary: Column | str, low: Column | str, currency: Column | str,
                       minimum: float | None = K.MIN_PLAUSIBLE_SALARY,
                       maximum: float | None = K.MAX_PLAUSIBLE_SALARY) -> Column:
    """Why a row is unusable ('no salary', 'non-USD', 'implausible'), or NULL when it is kept.

    A missing currency counts as USD and a missing amount is never implausible.
    """
    salary, currency = col(salary), col(currency)
    bad = F.lit(False)
    if minimum is not None:
        bad = bad | F.coalesce(salary < minimum, F.lit(False))
    if maximum is not None:
        bad = bad | F.coalesce(salary > maximum, F.lit(False))
    return (F.when(salary.isNull() & col(low).isNull(), "no salary")
            .when(currency.isNotNull() & (currency != "USD"), "non-USD")
            .when(bad, "implausible"))


def tier_between(salary: Column | str, low_max: Column | float, mid_max: Column | float,
                 labels: Sequence[str] = tuple(K.TIER_LABELS)) -> Column:
    """Right-closed tiers: a value on a boundary belongs to the lower tier; NULL stays NULL."""
    salary = col(salary)
    return (F.when(salary <= low_max, labels[0]).when(salary <= mid_max, labels[1])
            .when(salary.isNotNull(), labels[2]))


def fixed_tier(salary: Column | str) -> Column:
    """Tier by the frozen boundaries."""
    return tier_between(salary, F.lit(K.LOW_MAX), F.lit(K.MID_MAX))


def tier_code(tier: Column | str) -> Column:
    """0, 1, 2 for Low, Mid, High."""
    return lookup(tier, {label: i for i, label in enumerate(K.TIER_LABELS)})


def ordinal_bucket(value: Column | str, bounds: Sequence[float] = tuple(K.COMPANY_SIZE_BOUNDS)) -> Column:
    """Right-closed class 1..n+1 of a positive number; missing or 0 gives 0."""
    value = col(value)
    out = F.when(value.isNull() | (value <= 0), 0)
    for code, bound in enumerate(bounds, 1):
        out = out.when(value <= bound, code)
    return out.otherwise(len(bounds) + 1)


def first_mapped(items: Column | str, table: Mapping, default: str = "Unknown") -> Column:
    """The mapped value of the first item the table knows."""
    mapped = F.filter(F.transform(col(items), lambda x: lookup(x, table)), lambda x: x.isNotNull())
    return F.coalesce(F.get(mapped, 0), F.lit(default))


def strict_bool(text: Column | str) -> Column:
    """Only 'True' and 'False' (any case, blanks around); anything else is NULL."""
    token = F.lower(F.trim(col(text).cast("string")))
    return F.when(token == "true", True).when(token == "false", False)


def lenient_bool(text: Column | str) -> Column:
    """'true' or '1' is true, anything else false."""
    return F.coalesce(F.lower(F.trim(col(text).cast("string"))).isin("true", "1"), F.lit(False))


def finite_or_null(text: Column | str) -> Column:
    """A finite number, or NULL for text, booleans, NaN and infinities."""
    number = col(text).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def salary_status(salary: Column | str, predicted: Column | str) -> Column:
    """unavailable, estimated or advertised."""
    return (F.when(col(salary).isNull(), "unavailable").when(col(predicted), "estimated")
            .otherwise("advertised"))


def blank_missing(text: Column | str) -> Column:
    """NULL for the tokens a dataframe reader takes as missing."""
    return F.when(~col(text).isin(K.MISSING_TOKENS), col(text))


def safe_json_number(value: Column | str) -> Column:
    """NaN and infinities as NULL, so JSON stays valid."""
    value = col(value)
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole, NULL when the whole is 0."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))
