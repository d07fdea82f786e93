"""Location parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ..scale import col
from .values import lookup

_CODES = {code: code for code in K.US_STATES.values()}


def state_of(part: Column) -> Column:
    """The code of a state name or code, else NULL."""
    return F.coalesce(lookup(F.upper(part), _CODES), lookup(F.lower(part), K.US_STATES))


def comma_parts(text: Column | str) -> Column:
    """Trimmed non-blank parts between commas."""
    return F.filter(F.transform(F.split(col(text), ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_location(raw: Column | str, country: str = "United States") -> Column:
    """City, state code, country and kind (city, metro, state, country) of a location text."""
    raw = col(raw)
    listed = comma_parts(raw)
    parts = F.when(F.get(F.reverse(listed), 0) == country, F.slice(listed, 1, F.size(listed) - 1)).otherwise(listed)
    n = F.size(parts)
    metro = raw.rlike(r"\b(Area|Metroplex|Greater)\b")
    last = F.trim(F.regexp_replace(F.get(parts, n - 1), r"\s+(Metropolitan\s+)?Area$", ""))
    state = state_of(last)
    kind = (F.when(n == 0, "country").when((n == 1) & state.isNotNull(), "state").when(n == 1, "metro")
            .when(metro, "metro").otherwise("city"))
    return F.struct(F.when(n > 1, F.get(parts, F.lit(0))).alias("city"),
                    F.when(n > 0, state).alias("state"),
                    F.lit(country).alias("country"), kind.alias("location_type"))


def extract_state(location: Column | str) -> Column:
    """The state of the last comma part that names one."""
    found = F.filter(F.transform(F.reverse(F.transform(F.split(col(location), ","), lambda x: F.trim(x))), state_of),
                     lambda x: x.isNotNull())
    return F.get(found, 0)


def first_state(locations: Column | str) -> Column:
    """The state of the first location in a list that has one."""
    return F.get(F.filter(F.transform(col(locations), extract_state), lambda x: x.isNotNull()), 0)


def posting_state(area: Column | str, display: Column | str) -> Column:
    """State from the structured area list (country, state, ...), else from the display text."""
    return F.coalesce(extract_state(F.get(col(area), 1)), extract_state(display))
