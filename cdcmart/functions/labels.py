"""Business labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcmart.functions.times import AsOf, date_lit

# Labels, bounds and country lists of the business rules.
DAY_PARTS = {
    "Morning": (6, 10),
    "Lunch": (11, 14),
    "Afternoon": (15, 18),
    "Evening": (19, 22),
}
OTHER_HOURS = "Night"
REGIONS = {
    "LATAM": ["BR", "AR", "CL", "CO", "MX", "PE", "UY"],
    "NA": ["US", "CA"],
    "EMEA": ["GB", "IE", "FR", "DE", "IT", "ES", "PT", "CZ", "RS"],
    "APAC": ["JP", "KR", "SG", "MY", "TH", "ID", "PH", "VN", "KZ"],
}
OTHER_REGION = "Other"
MATURITY_BELOW_DAYS = {"Ramp-Up": 90, "Young": 365, "Mature": 730}
OLDEST = "Established"


def local_hour(ts: Column, tz: Column) -> Column:
    """Hour of the day of the instant ``ts`` in the zone of its own row; NULL where the zone is NULL."""
    return F.hour(F.from_utc_timestamp(ts, tz))


def day_part(ts: Column, tz: Column) -> Column:
    """Part of the day of ``ts`` in zone ``tz``; an unknown hour counts as night."""
    by_hour = [OTHER_HOURS] * 24
    for label, (first, last) in DAY_PARTS.items():
        by_hour[first : last + 1] = [label] * (last - first + 1)
    # Indexing a constant array evaluates the zone conversion once; a chain of conditions would repeat it.
    labels = F.array(*[F.lit(label) for label in by_hour])
    return F.coalesce(F.get(labels, local_hour(ts, tz)), F.lit(OTHER_HOURS))


def region_of(country: Column) -> Column:
    label = F.lit(OTHER_REGION)
    for region, countries in reversed(REGIONS.items()):
        label = F.when(country.isin(countries), region).otherwise(label)
    return label


def store_age_days(opening: Column, as_of: AsOf) -> Column:
    return F.datediff(date_lit(as_of), opening)


def store_maturity(opening: Column, as_of: AsOf) -> Column:
    """Age class of a store; a store without opening date counts as the oldest."""
    age = store_age_days(opening, as_of)
    label = F.lit(OLDEST)
    for name, below in sorted(MATURITY_BELOW_DAYS.items(), key=lambda item: -item[1]):
        label = F.when(age < below, name).otherwise(label)
    return label
