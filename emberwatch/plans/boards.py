"""The composite queries of the two dashboards."""

from pyspark.sql import functions as F

from emberwatch import constants as K
from emberwatch.functions import labels, numbers, times
from emberwatch.functions.display import fixed_measure
from emberwatch.functions.places import zone_label
from emberwatch.operators import clean, explore, freshness, history, latest, zones
from emberwatch.schemas import PREDICTION_COLUMNS, PROBABILITIES


def current(predictions, now=None, stale_seconds=K.STALE_SECONDS, prune=None):
    """Latest row per sensor, coerced, with its freshness."""
    newest = latest.latest_by_max_id(predictions.select(*PREDICTION_COLUMNS), prune=prune)
    return freshness.add_freshness(clean.prepare_predictions(newest), now, stale_seconds)


def recent(predictions, now=None, stale_seconds=K.STALE_SECONDS, n=K.HISTORY_ROWS, prune=None):
    """The history window, coerced, with freshness."""
    newest = history.recent_history(predictions.select(*PREDICTION_COLUMNS), n, prune)
    return freshness.add_freshness(clean.prepare_predictions(newest), now, stale_seconds)


def zone_board(predictions, now=None, stale_seconds=K.STALE_SECONDS):
    """Safety state of all configured zones."""
    return zones.zone_board(current(predictions, now, stale_seconds))


def current_board(board):
    """One display row per sensor, most urgent first; ``board`` from ``current``."""
    c = F.col
    shown = history.by_urgency(board).select(
        "sensor_id",
        zone_label(c("zone")),
        times.format_time(c("data_time")),
        labels.freshness_text(c("is_fresh")),
        "temperature", "humidity", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm",
        labels.status_text(c("prediction_label")),
    )
    return clean.rename_display(shown, K.BOARD_HEADINGS)


def active_alert_cards(board, k=4):
    """The most urgent alerts as shown on cards."""
    c = F.col
    label = c("prediction_label")
    return history.active_alerts(board, k).select(
        labels.text_for(label, K.ALERT_CARD_TEXT).alias("alert_type"),
        times.format_time(c("data_time")).alias("time"),
        labels.freshness_text(c("is_fresh"), K.CARD_FRESH_TEXT, K.CARD_STALE_TEXT).alias("freshness"),
        "sensor_id",
        zone_label(c("zone")).alias("zone_name"),
        _measure("temperature", 1), _measure("smoke_ppm", 0), _measure("lpg_gas_ppm", 0), _measure("co_gas_ppm", 0),
    )




def _measure(name, digits):
    return fixed_measure(F.col(name), digits).alias(name)


def incident_log(window, label=None, zone=None):
    """Alerts of the history window for display and export, newest first."""
    c = F.col
    chosen = history.history_filter(history.alert_history(window), label, zone)
    shown = chosen.select(
        "id",
        "sensor_id",
        zone_label(c("zone")),
        times.format_time(c("timestamp"), missing=None),
        "temperature", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm",
        numbers.percent_rounded(c("probability_risk")),
        numbers.percent_rounded(c("probability_fire")),
        labels.incident_text(c("prediction_label")),
    )
    return clean.rename_display(shown, K.INCIDENT_HEADINGS)


def sensor_explorer(window, zone=None, status=None, text="", n=100):
    """Search within the history window."""
    c = F.col
    page = explore.explorer_page(explore.explorer_filter(window, zone, status, text), n)
    shown = page.select(
        "id",
        "sensor_id",
        zone_label(c("zone")),
        times.format_time(c("timestamp")),
        times.format_time(c("created_at")),
        labels.freshness_text(c("is_fresh")),
        "temperature", "humidity", "smoke_ppm", "lpg_gas_ppm", "co_gas_ppm",
        labels.status_text(c("prediction_label")),
    )
    return clean.rename_display(shown, K.EXPLORER_HEADINGS)


def latest_probabilities(predictions, prune=None):
    """Class shares of the newest row, brought to a sum of 100."""
    newest = clean.prepare_predictions(latest.latest_record(predictions, prune))
    shares = numbers.renormalised(*[F.col(name) for name in PROBABILITIES])
    return newest.select(
        "id", "sensor_id", zone_label(F.col("zone")).alias("zone_name"), "prediction_label",
        *[share.alias(f"pct_{name.removeprefix('probability_')}") for name, share in zip(PROBABILITIES, shares)],
    )
