"""Search over readings."""

from pyspark.sql import functions as F

from emberwatch.operators.history import history_filter, recent_history


def explorer_filter(frame, zone=None, status=None, text=""):
    """Zone, label and a case-insensitive regular expression on the sensor id."""
    pattern = text.strip()
    frame = history_filter(frame, status, zone)
    if pattern:
        frame = frame.filter(F.col("sensor_id").rlike("(?iu)" + pattern))
    return frame


def explorer_page(frame, n=100, prune=False):
    """The newest matching rows."""
    return recent_history(frame, n, prune)


def web_filter(records, text="", status="ALL", zone="ALL"):
    """Literal search on sensor or zone name, with status and zone name; over all records."""
    needle = text.strip().lower()
    if needle:
        found = F.lower("sensor").contains(needle) | F.lower("zone_name").contains(needle)
        records = records.filter(found)
    if status != "ALL":
        records = records.filter(F.col("status") == status)
    if zone != "ALL":
        records = records.filter(F.col("zone_name") == zone)
    return records
