"""Every query by name, over tables derived from a folder's ``events``."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from emberwatch.constants import ABNORMAL_LABELS, FEATURES
from emberwatch.functions import display, labels, numbers, places, times
from emberwatch.ml import training
from emberwatch.operators import alerts, clean, explore, freshness, history, latest, metrics, trend, web, zones
from emberwatch.plans import boards, stored
from emberwatch.schemas import PREDICTION_COLUMNS, PROBABILITIES
from emberwatch.sources import events, readings
from emberwatch.sources.shared import new_folder
from emberwatch.streaming.outbox import Outbox

# Readings of the given tables lie minutes apart, so the usual 120 seconds would leave
# nearly every sensor stale.
NOW = "2024-01-31 00:00:00"
STALE = 14_400
DIGITS = 9  # means are compared to nine decimals
ACCURACY_FLOOR = 0.8  # every model reaches it on the labels of the threshold rule

c = F.col


def _rounded(frame, *names):
    return frame.withColumns({name: F.round(name, DIGITS) for name in names})


def _predictions(spark, folder):
    return events.predictions(spark, folder)


def _current(spark, folder):
    return boards.current(_predictions(spark, folder), NOW, STALE)


def _recent(spark, folder):
    return boards.recent(_predictions(spark, folder), NOW, STALE)


def _records(spark, folder):
    return web.prepare_records(events.api_records(spark, folder), NOW, STALE)


def _latest_records(spark, folder):
    return web.latest_sensors(events.api_records(spark, folder), NOW, STALE)


def _abnormal(spark, folder):
    return latest.latest_abnormal(_predictions(spark, folder))


def _indexed(spark, folder):
    return alerts.alert_index(alerts.alert_groups(_abnormal(spark, folder)))


def _labelled(spark, folder):
    """Labels by the threshold rule, and a second opinion that is wrong for every tenth row."""
    rows = _predictions(spark, folder)
    other = (c("prediction") + F.when(c("id") % 10 == 0, 1).otherwise(0)) % 3
    return rows.select("id", *FEATURES, c("prediction").alias("label"), other.cast("double").alias("prediction"))


def _confusion(spark, folder):
    return metrics.confusion_matrix(_labelled(spark, folder))


def _training(spark, folder):
    rows = _labelled(spark, folder).dropna(subset=FEATURES).select("id", *FEATURES, "label")
    train_rows, test_rows = training.split_by_key(rows)
    return training.training_rows(train_rows), training.training_rows(test_rows)


def _fitted(spark, folder, name):
    train_rows, test_rows = _training(spark, folder)
    return training.train(name, train_rows), test_rows


# --- parse, project, filter


def parse_json(spark, folder):
    return readings.readings_of(events.messages(spark, folder))


def prediction_codes(spark, folder):
    code = labels.class_code(c("prediction").cast("double"))
    return _predictions(spark, folder).select("id", code.alias("code"), labels.class_label(code).alias("label"))


def prediction_table_projection(spark, folder):
    rows = _predictions(spark, folder).withColumn("prediction", c("prediction").cast("double"))
    return clean.prediction_table_projection(rows)


def rename_display(spark, folder):
    rows = _predictions(spark, folder).select("id", "sensor_id", "zone")
    return clean.rename_display(rows, ["ID", "Mã Sensor", "Khu Vực"])


def add_freshness(spark, folder):
    rows = freshness.add_freshness(clean.prepare_predictions(_predictions(spark, folder)), NOW, STALE)
    return rows.select("id", "data_time", "age_seconds", "is_fresh")


def fresh_split(spark, folder):
    fresh, stale = freshness.fresh_split(_current(spark, folder))
    parts = [(fresh, "fresh"), (stale, "stale")]
    first, second = [part.select("id", "sensor_id", F.lit(name).alias("part")) for part, name in parts]
    return first.unionAll(second)


def connection_state(spark, folder):
    return _records(spark, folder).select("id", "connection")


def drop_missing_metric(spark, folder):
    return clean.drop_missing_metric(_predictions(spark, folder), "temperature").select("id", "temperature")


def history_filter(spark, folder):
    chosen = history.history_filter(_predictions(spark, folder), "FIRE_RISK", "Kho_Hoa_Chat")
    return chosen.select("id", "sensor_id", "zone", "prediction_label")


def explorer_filter(spark, folder):
    chosen = explore.explorer_filter(_predictions(spark, folder), "Phong_May", "NORMAL", " s0[0-2] ")
    return chosen.select("id", "sensor_id", "zone", "prediction_label")


def web_filter(spark, folder):
    chosen = explore.web_filter(_records(spark, folder), " KHU ", "NORMAL")
    return chosen.select("id", "sensor", "zone_name", "status")


def web_filter_zone(spark, folder):
    chosen = explore.web_filter(_records(spark, folder), "s01", "ALL", "Kho Hóa Chất")
    return chosen.select("id", "sensor", "zone_name", "status")


def zone_match(spark, folder):
    return web.zone_match(_latest_records(spark, folder)).select("zone_key", "id", "sensor")


# --- names and other scalars


def zone_display(spark, folder):
    return zones.zone_display(_predictions(spark, folder)).select("id", "zone_label")


def zone_display_join(spark, folder):
    return zones.zone_display(_predictions(spark, folder), zones.zone_dimension(spark)).select("id", "zone_label")


def pick_identity(spark, folder):
    return _records(spark, folder).select("id", "sensor", "raw_zone", "zone_name")


def normalise_label(spark, folder):
    raw = events.raw_predictions(spark, folder)
    return raw.select("id", labels.normalise_label(c("prediction_label")).alias("label"))


def status_alias(spark, folder):
    return _records(spark, folder).select("id", "status")


def resolve_status(spark, folder):
    raw = events.raw_predictions(spark, folder)
    return raw.select("id", labels.resolve_status(c("prediction_label"), c("prediction")).alias("status"))


def is_missing(spark, folder):
    raw = events.raw_predictions(spark, folder)
    names = ["zone", "temperature", "humidity", "probability_normal", "created_at"]
    return raw.select("id", *[labels.is_missing(c(name)).alias(f"{name}_missing") for name in names])


def display_measure(spark, folder):
    rows = _predictions(spark, folder)
    shown = {name: display.display_measure(c(name), " ppm").alias(name) for name in ("temperature", "smoke_ppm", "co_gas_ppm")}
    return rows.select("id", *shown.values())


def fixed_measure(spark, folder):
    rows = _predictions(spark, folder)
    return rows.select(
        "id", display.fixed_measure(c("temperature"), 1).alias("one"), display.fixed_measure(c("temperature"), 0).alias("none"),
        display.fixed_measure(c("co_gas_ppm"), 2).alias("two"),
    )


def display_probability(spark, folder):
    raw = events.raw_predictions(spark, folder)
    return raw.select("id", *[display.display_probability_text(c(name)).alias(name) for name in PROBABILITIES])


def display_measure_text(spark, folder):
    raw = events.raw_predictions(spark, folder)
    return raw.select("id", *[display.display_measure_text(c(name), " %").alias(name) for name in ("temperature", "humidity")])


def display_texts(spark, folder):
    rows = clean.prepare_predictions(_predictions(spark, folder))
    rows = freshness.add_freshness(rows, NOW, STALE)
    label = c("prediction_label")
    return rows.select(
        "id",
        labels.status_text(label).alias("status"),
        labels.incident_text(label).alias("incident"),
        labels.web_status_text(labels.normalise_status(label)).alias("web_status"),
        labels.freshness_text(c("is_fresh")).alias("freshness"),
    )


def parse_times(spark, folder):
    raw = events.raw_predictions(spark, folder)
    sensor, stored = times.parse_time(c("timestamp")), times.parse_time(c("created_at"))
    return raw.select("id", sensor.alias("sensor_time"), stored.alias("store_time"), times.data_time(stored, sensor).alias("data_time"))


def data_time_web(spark, folder):
    return _records(spark, folder).select("id", "record_time")


def format_time(spark, folder):
    rows = _predictions(spark, folder)
    return rows.select("id", times.format_time(c("created_at")).alias("stored"))


def to_number(spark, folder):
    raw = events.raw_predictions(spark, folder)
    names = ["temperature", "humidity", "probability_normal", "probability_fire"]
    return raw.select(
        "id", *[numbers.to_number(c(name)).alias(name) for name in names],
        numbers.safe_float(c("humidity"), -1.0).alias("humidity_or"),
    )


def percent_clamped(spark, folder):
    raw = events.raw_predictions(spark, folder)
    return raw.select("id", *[numbers.percent_clamped(c(name)).alias(name) for name in PROBABILITIES])


def percent_rounded(spark, folder):
    rows = _predictions(spark, folder)
    return rows.select("id", numbers.percent_rounded(c("probability_risk")).alias("risk"), numbers.percent_rounded(c("smoke_ppm") / 7).alias("smoke"))


def renormalise_probabilities(spark, folder):
    rows = clean.prepare_predictions(events.raw_predictions(spark, folder))
    shares = numbers.renormalised(*[c(name) for name in PROBABILITIES])
    return rows.select("id", *[F.round(share, DIGITS).alias(name) for name, share in zip(PROBABILITIES, shares)])


def threshold_classify(spark, folder):
    rows = readings.load_frame(spark.read.parquet(f"{folder}/events.parquet").select(c("event_id").alias("id")))
    label = labels.threshold_label(c("temperature"), c("smoke_ppm"))
    return rows.groupBy("sensor_id", label.alias("label")).agg(F.count("*").alias("rows"))


def load_frame(spark, folder):
    return readings.load_frame(spark.read.parquet(f"{folder}/events.parquet").select(c("event_id").alias("id")))


# --- aggregates


def zone_stats(spark, folder):
    return _rounded(zones.zone_stats(_current(spark, folder)), "avg_temp", "avg_smoke")


def zone_board(spark, folder):
    return _rounded(boards.zone_board(_predictions(spark, folder), NOW, STALE), "avg_temp", "avg_smoke")


def status_kpis(spark, folder):
    return _rounded(freshness.status_kpis(_current(spark, folder)), "pct_normal", "pct_risk", "pct_fire")


def metric_trend(spark, folder):
    return _rounded(trend.metric_trend(_recent(spark, folder), "temperature"), "value")


def _metric_trend(name):
    return lambda spark, folder: _rounded(trend.metric_trend(_recent(spark, folder), name), "value")


def data_check(spark, folder):
    """The newest rows of the chosen columns, as a look at the data."""
    columns = ["id", "sensor_id", "zone", "timestamp", *FEATURES, "prediction_label"]
    newest = _recent(spark, folder).orderBy(F.desc("id"))
    return clean.preview(clean.select_existing(newest, columns), 60)


def trend_reference(spark, folder):
    return _rounded(trend.trend_reference(trend.metric_trend(_recent(spark, folder), "smoke_ppm")), "average")


def alert_totals(spark, folder):
    return history.alert_totals(_current(spark, folder), _recent(spark, folder))


def status_breakdown(spark, folder):
    return _rounded(web.status_breakdown(web.web_overview(_latest_records(spark, folder))), "percent")


def web_zone_summary(spark, folder):
    return _rounded(web.web_zone_summary(_latest_records(spark, folder)), "online_percent")


def mean_probabilities(spark, folder):
    return _rounded(web.mean_probabilities(_latest_records(spark, folder)), *PROBABILITIES)


def row_counts(spark, folder):
    held_out = training.is_held_out()
    return metrics.row_counts(_predictions(spark, folder), train=~held_out, test=held_out)


def multiclass_metrics(spark, folder):
    return _rounded(metrics.multiclass_metrics(_confusion(spark, folder)), "accuracy", "f1", "precision", "recall")


# --- latest, history, alerts


def latest_by_time(spark, folder):
    return _latest_records(spark, folder).select("id", "sensor", "status", "connection", "record_time")


def numbered_history(spark, folder, prune=False):
    rows = web.numbered_history(web.identify(events.api_records(spark, folder)), prune=prune)
    return rows.select("number", "id", "sensor", "record_time")


def history_by_time(spark, folder, prune=False):
    newest = web.history_by_time(web.identify(events.api_records(spark, folder)), prune=prune)
    return web.describe(newest, NOW, STALE).select("id", "sensor", "zone_name", "status", "record_time")


def active_alerts(spark, folder):
    return history.active_alerts(_current(spark, folder)).select("id", "sensor_id", "prediction_label", "is_fresh", "status_priority")


def tail_by_time(spark, folder, prune=False):
    return trend.tail_by_time(_predictions(spark, folder), "temperature", prune=prune).select("id", "timestamp", "temperature")


def alert_history(spark, folder):
    return history.alert_history(_recent(spark, folder)).select("id", "sensor_id", "prediction_label")


def current_status_table(spark, folder):
    return history.by_urgency(_current(spark, folder)).select(*PREDICTION_COLUMNS, "is_fresh")


def explorer_page(spark, folder, prune=False):
    return explore.explorer_page(_predictions(spark, folder), prune=prune).select(*PREDICTION_COLUMNS)


def top_alerts(spark, folder):
    return web.web_alerts(_latest_records(spark, folder), 5).select("id", "sensor", "status")


def web_alert_list(spark, folder):
    shown = web.web_alerts(_latest_records(spark, folder))
    return shown.select("id", "sensor", "zone_name", "status", numbers.web_number(c("temperature")).alias("temperature"), "record_time")


def compact_list(spark, folder):
    return web.newest_records(_latest_records(spark, folder), 6).select("id", "sensor", "zone_name", "status", "connection")


def alert_index(spark, folder):
    return _indexed(spark, folder).select("severity_rank", "severity", "sensors", "alert_number", "sensor_id", "zone", "id")


def alert_sensor_text(spark, folder):
    rows = _predictions(spark, folder).withColumn("timestamp", times.format_time(c("timestamp")))
    return rows.filter(c("prediction_label").isin(ABNORMAL_LABELS)).select("id", alerts.alert_sensor_text().alias("text"))


def alert_header(spark, folder):
    rows = alerts.alert_group_sizes(alerts.alert_groups(_abnormal(spark, folder)))
    return rows.select("severity_rank", "severity", "sensors", alerts.alert_header().alias("header"))


def alert_message(spark, folder):
    rows = _indexed(spark, folder).withColumn("timestamp", times.format_time(c("timestamp")))
    return alerts.alert_message(rows)


def alert_message_parts(spark, folder):
    return alerts.alert_message_parts(alert_message(spark, folder))


def alert_outbox(spark, folder):
    """What is pending after a replay of the batch and after the first message is sent."""
    outbox = Outbox(spark, new_folder(spark, "outbox"))
    for _ in range(2):
        outbox.put(alert_message_parts(spark, folder), 0, "plant")
    first = outbox.pending().agg(F.min("send_order").alias("first")).first()["first"]
    if first is not None:
        outbox.mark_sent(first)
    place = (c("send_order") - F.lit(first)).alias("place")
    return outbox.pending().select(place, "severity_rank", "part", "text")


# --- models


def split_train_test(spark, folder):
    part = F.when(training.is_held_out(), "test").otherwise("train")
    return _predictions(spark, folder).select("id", "sensor_id", part.alias("part"))


def _trained(name):
    def query(spark, folder):
        model, test_rows = _fitted(spark, folder, name)
        return metrics.multiclass_metrics(training.evaluate(model, test_rows)).select(F.lit(name).alias("model"), "*")

    return query


def score(spark, folder):
    model, _ = _fitted(spark, folder, "DT1")
    rows = _labelled(spark, folder).dropna(subset=FEATURES).select("id", *FEATURES, "label")
    return training.label_scores(training.score(model, rows)).drop("features", "rawPrediction", "probability")


def feature_importance(spark, folder):
    model, _ = _fitted(spark, folder, "RF1")
    return training.feature_importance(spark, model)


def model_leaderboard(spark, folder):
    train_rows, test_rows = _training(spark, folder)
    return training.model_leaderboard(spark, train_rows, test_rows).drop("training_seconds", "settings")


def pick_model(spark, folder):
    train_rows, test_rows = _training(spark, folder)
    return training.pick_model(training.model_leaderboard(spark, train_rows, test_rows)).select("model", "f1")


def model_facts(spark, folder):
    """What must hold for each of the twelve models, whatever was learnt: rows tested, and a floor."""
    train_rows, test_rows = _training(spark, folder)
    board = training.model_leaderboard(spark, train_rows, test_rows)
    tested = test_rows.agg(F.count("*").alias("tested"))
    return board.select("model", "family", (c("accuracy") >= ACCURACY_FLOOR).alias("accurate"), tested.scalar().alias("tested"))


def score_facts(spark, folder):
    """For every scored row: shares that sum to one, and a label that agrees with the code and the highest share."""
    shares = [c(name) for name in PROBABILITIES]
    codes = F.array(*[F.when(share == F.greatest(*shares), F.lit(float(code))) for code, share in enumerate(shares)])
    return score(spark, folder).select(
        "id",
        (F.abs(sum(shares[1:], shares[0]) - 1) < 1e-9).alias("sums_to_one"),
        (c("prediction_label") == labels.class_label(c("prediction").cast("int"))).alias("label_agrees"),
        F.array_contains(F.array_compact(codes), c("prediction")).alias("highest"),
    )


def importance_facts(spark, folder):
    """The importances are shares of one, none of them negative."""
    shares = feature_importance(spark, folder)
    return shares.agg(
        F.count("*").alias("features"),
        F.round(F.sum("importance"), DIGITS).alias("total"),
        F.bool_and(c("importance") >= 0).alias("valid"),
    )


def training_quality(spark, folder):
    """Rows given to training and rows left out because a measure is missing or no number."""
    unusable = reduce(or_, [c(name).isNull() | F.isnan(name) for name in FEATURES])
    return _labelled(spark, folder).agg(
        F.count("*").alias("rows"), F.count_if(~unusable).alias("used"), F.count_if(unusable).alias("left_out")
    )


QUERIES = {
    # sources, parsing, projection
    "load_frame": load_frame,
    "parse_json": parse_json,
    "validate_readings": lambda s, f: clean.validate_readings(parse_json(s, f)),
    "reading_quality": lambda s, f: clean.reading_quality(parse_json(s, f)),
    "prediction_codes": prediction_codes,
    "prediction_table_projection": prediction_table_projection,
    "rename_display": rename_display,
    "alert_projection_fire": lambda s, f: alerts.alert_projection(_abnormal(s, f), 2),
    "alert_projection_risk": lambda s, f: alerts.alert_projection(_abnormal(s, f), 1),
    # filters
    "abnormal_codes": lambda s, f: _predictions(s, f).filter(c("prediction").isin(1, 2)).select("id", "prediction"),
    "abnormal_labels": lambda s, f: history.abnormal_only(_predictions(s, f)).select("id", "prediction_label"),
    "by_class": lambda s, f: history.by_class(_predictions(s, f), 2).select("id", "sensor_id", "prediction"),
    "add_freshness": add_freshness,
    "fresh_split": fresh_split,
    "connection_state": connection_state,
    "drop_missing_metric": drop_missing_metric,
    "history_filter": history_filter,
    "explorer_filter": explorer_filter,
    "web_filter": web_filter,
    "web_filter_zone": web_filter_zone,
    "zone_match": zone_match,
    # joins
    "latest_by_max_id": lambda s, f: latest.latest_by_max_id(_predictions(s, f), ordered=True),
    "latest_by_max_id_pruned": lambda s, f: latest.latest_by_max_id(_predictions(s, f), prune=True),
    "latest_by_max_id_join": lambda s, f: latest.latest_by_max_id_join(_predictions(s, f)),
    "zone_board": zone_board,
    "web_zone_summary": web_zone_summary,
    "zone_display": zone_display,
    "zone_display_join": zone_display_join,
    # aggregates
    "class_distribution": lambda s, f: metrics.class_distribution(_labelled(s, f)),
    "confusion_matrix": _confusion,
    "class_errors": lambda s, f: metrics.class_errors(_confusion(s, f)),
    "max_id_per_sensor": lambda s, f: latest.max_id_per_sensor(_predictions(s, f)),
    "sensor_counts": lambda s, f: freshness.sensor_counts(_current(s, f)),
    "status_kpis": status_kpis,
    "zone_stats": zone_stats,
    "metric_trend": metric_trend,
    **{f"metric_trend_{name}": _metric_trend(name) for name in FEATURES if name != "temperature"},
    "data_check": data_check,
    "trend_reference": trend_reference,
    "alert_totals": alert_totals,
    "web_overview": lambda s, f: web.web_overview(_latest_records(s, f)),
    "status_breakdown": status_breakdown,
    "mean_probabilities": mean_probabilities,
    "row_counts": row_counts,
    "multiclass_metrics": multiclass_metrics,
    "distinct_zones": lambda s, f: web.distinct_zones(_latest_records(s, f)),
    "web_alert_totals": lambda s, f: web.web_alert_totals(_latest_records(s, f)),
    "web_history_totals": lambda s, f: web.web_history_totals(web.identify(events.api_records(s, f))),
    # ranking, newest rows
    "latest_abnormal": _abnormal,
    "latest_by_time": latest_by_time,
    "numbered_history": numbered_history,
    "alert_index": alert_index,
    "recent_history": lambda s, f: history.recent_history(_predictions(s, f)),
    "recent_history_pruned": lambda s, f: history.recent_history(_predictions(s, f), prune=True),
    "tail_by_time_pruned": lambda s, f: tail_by_time(s, f, True),
    "explorer_page_pruned": lambda s, f: explorer_page(s, f, True),
    "latest_record_pruned": lambda s, f: latest.latest_record(_predictions(s, f), prune=True),
    "history_by_time_pruned": lambda s, f: history_by_time(s, f, True),
    "numbered_history_pruned": lambda s, f: numbered_history(s, f, True),
    "latest_abnormal_pruned": lambda s, f: latest.latest_abnormal(_predictions(s, f), prune=True),
    "active_alerts": active_alerts,
    "tail_by_time": tail_by_time,
    "alert_history": alert_history,
    "current_status_table": current_status_table,
    "explorer_page": explorer_page,
    "latest_record": lambda s, f: latest.latest_record(_predictions(s, f)),
    "history_by_time": history_by_time,
    "top_alerts": top_alerts,
    "web_alert_list": web_alert_list,
    "compact_list": compact_list,
    # scalars
    "pick_identity": pick_identity,
    "normalise_label": normalise_label,
    "status_alias": status_alias,
    "resolve_status": resolve_status,
    "is_missing": is_missing,
    "display_measure": display_measure,
    "display_measure_text": display_measure_text,
    "fixed_measure": fixed_measure,
    "display_probability": display_probability,
    "display_texts": display_texts,
    "parse_times": parse_times,
    "data_time_web": data_time_web,
    "format_time": format_time,
    "to_number": to_number,
    "percent_clamped": percent_clamped,
    "percent_rounded": percent_rounded,
    "renormalise_probabilities": renormalise_probabilities,
    "threshold_classify": threshold_classify,
    "plant_banner": lambda s, f: freshness.plant_banner(_current(s, f)),
    # composites
    "prepare_predictions": lambda s, f: clean.prepare_predictions(events.raw_predictions(s, f)),
    "current_board": lambda s, f: boards.current_board(_current(s, f)),
    "active_alert_cards": lambda s, f: boards.active_alert_cards(_current(s, f)),
    "incident_log": lambda s, f: boards.incident_log(_recent(s, f)),
    "incident_log_filtered": lambda s, f: boards.incident_log(_recent(s, f), "FIRE_RISK", "Khu_Kiem_Tra"),
    "sensor_explorer": lambda s, f: boards.sensor_explorer(_recent(s, f), text="S0"),
    "sensor_explorer_filtered": lambda s, f: boards.sensor_explorer(_recent(s, f), "Phong_May", "NORMAL", "s0[0-4]"),
    "latest_probabilities": lambda s, f: boards.latest_probabilities(_predictions(s, f)),
    "online_probability_table": lambda s, f: web.online_probability_table(_latest_records(s, f)),
    # alert messages
    "alert_groups": lambda s, f: alerts.alert_group_sizes(alerts.alert_groups(_abnormal(s, f))),
    "alert_sensor_text": alert_sensor_text,
    "alert_header": alert_header,
    "alert_message": alert_message,
    "alert_message_parts": alert_message_parts,
    "alert_outbox": alert_outbox,
    # models
    "split_train_test": split_train_test,
    "train_random_forest": _trained("RF1"),
    "train_decision_tree": _trained("DT1"),
    "train_logistic": _trained("LR1"),
    "score": score,
    "feature_importance": feature_importance,
    "model_leaderboard": model_leaderboard,
    "pick_model": pick_model,
    "train_deployed_forest": _trained("RF3"),
    "model_facts": model_facts,
    "score_facts": score_facts,
    "importance_facts": importance_facts,
    "training_quality": training_quality,
}
QUERIES |= stored.QUERIES
