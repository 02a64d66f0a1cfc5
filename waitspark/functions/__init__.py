from waitspark.functions.hashing import hash_unit, in_hash_sample
from waitspark.functions.text import (
    SIGNED_DECIMAL,
    UNSIGNED_INTEGER,
    cell_text,
    clean_time,
    extract_number,
    merge_datetime,
    strip,
    url_param,
    url_param_date,
    zone_label,
)
from waitspark.functions.times import (
    trip_calendar,
    trip_time_parts,
    wait_minutes,
    weather_time_parts,
)

__all__ = [
    "SIGNED_DECIMAL",
    "UNSIGNED_INTEGER",
    "cell_text",
    "clean_time",
    "extract_number",
    "hash_unit",
    "in_hash_sample",
    "merge_datetime",
    "strip",
    "trip_calendar",
    "trip_time_parts",
    "url_param",
    "url_param_date",
    "wait_minutes",
    "weather_time_parts",
    "zone_label",
]
