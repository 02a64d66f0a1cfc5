"""Left joins of weather and zones to trips, and of zone means to shapes.

Dimensions are files or written tables, so the optimizer knows their size: below the session's
threshold they are broadcast and trips are not shuffled; above it the join shuffles, and adaptive
execution splits a key that holds many trips. No hint overrides that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_weather(trips: DataFrame, weather_hours: DataFrame) -> DataFrame:
    """Attaches the reading of the request's date and hour; ``weather_hours`` has one per hour."""
    same_hour = (trips["request_date"] == weather_hours["weather_date"]) & (
        trips["request_hour"] == weather_hours["weather_hour"]
    )
    return trips.join(weather_hours, same_hour, "left")


def zone_role(zones: DataFrame, role: str) -> DataFrame:
    """The zone dimension under the names of one role: "PU" pickup or "DO" drop-off."""
    return zones.select(
        F.col("LocationID").alias(f"{role}LocationID"),
        F.col("Zone").alias(f"{role}LocationZone"),
        F.col("Borough").alias(f"{role}Borough"),
    )


def join_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Attaches zone and borough of pickup and drop-off."""
    for role in ("PU", "DO"):
        trips = trips.join(zone_role(zones, role), f"{role}LocationID", "left")
    return trips


def zone_map(shapes: DataFrame, zone_means: DataFrame) -> DataFrame:
    """Shapes with the mean wait of the zone of the same name, 0 where there is none.

    Names repeat on both sides, and every pairing is kept.
    """
    same_name = shapes["zone"] == zone_means["PULocationZone"]
    joined = shapes.join(zone_means, same_name, "left")
    return joined.fillna({"avg_wait_minutes": 0.0})
