from cdcmart.functions.casts import NUMERIC, RATE, cast_columns, round_to_long, safe_cast
from cdcmart.functions.compare import differs, same
from cdcmart.functions.labels import day_part, local_hour, region_of, store_age_days, store_maturity
from cdcmart.functions.times import as_date, as_micros, date_lit, instant_lit

__all__ = [
    "NUMERIC",
    "RATE",
    "as_date",
    "as_micros",
    "cast_columns",
    "date_lit",
    "day_part",
    "differs",
    "instant_lit",
    "local_hour",
    "region_of",
    "round_to_long",
    "safe_cast",
    "same",
    "store_age_days",
    "store_maturity",
]
