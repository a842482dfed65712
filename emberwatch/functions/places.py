"""Zone names."""

from pyspark.sql import functions as F

from emberwatch.constants import UNKNOWN, ZONE_MISSING_WEB, ZONES
from emberwatch.functions.labels import text_for


def zone_label(zone):
    """Display name of a zone key; unknown keys stay as they are."""
    return text_for(zone, ZONES)


def zone_label_web(zone):
    """Display name of a zone key; unknown keys are shown with blanks for underscores."""
    return text_for(zone, ZONES, F.regexp_replace(zone, "_", " "))


def record_sensor(sensor_id, record_id):
    return F.coalesce(sensor_id, record_id, F.lit(UNKNOWN))


def record_zone(zone, area, location):
    return F.coalesce(zone, area, location, F.lit(ZONE_MISSING_WEB))
