"""Splitting, fitting, scoring, comparing."""

import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from threading import BoundedSemaphore

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from emberwatch.constants import FEATURES, RANDOM_FORESTS, SEED
from emberwatch.functions.labels import class_label
from emberwatch.functions.vectors import class_probability
from emberwatch.ml.grid import configurations, pipeline
from emberwatch.operators.metrics import confusion_matrix, multiclass_metrics
from emberwatch.schemas import PROBABILITIES

#: Models that are fitted side by side.
FITS_AT_ONCE = 4
#: Rows for each core from which on training rows are dealt evenly over all cores.
ROWS_PER_CORE = 20_000
_METRICS = ["accuracy", "f1", "precision", "recall"]


def training_rows(frame, label="label"):
    """Only what fitting needs, so that only this is kept in memory."""
    return frame.select(*FEATURES, F.col(label).cast("int").alias("label"))


def split_train_test(frame, shares=(0.8, 0.2), seed=SEED):
    """Random split. Which rows go where depends on how the frame is partitioned."""
    return frame.randomSplit([*shares], seed)


def split_by_key(frame, key="id", fifths=1):
    """Split by a whole-number key: the same rows on every run and every cluster size."""
    held_out = is_held_out(key, fifths)
    return frame.filter(~held_out), frame.filter(held_out)


def is_held_out(key="id", fifths=1):
    """The test rows of ``split_by_key``."""
    return F.pmod(F.col(key), F.lit(5)) < fifths


def split_by_hash(frame, keys, test_percent=20):
    """As ``split_by_key`` for keys of any type."""
    held_out = F.pmod(F.xxhash64(*keys), F.lit(100)) < test_percent
    return frame.filter(~held_out), frame.filter(held_out)


def spread(rows):
    """Many rows dealt evenly over all cores; few, or rows in more parts than that, stay as they lie.

    Every level of a tree is a pass that lasts as long as its fullest task, and the parts of a
    file are as uneven as its row groups. No more parts than cores: each sends the statistics of
    all nodes. Forests draw their samples per part, so they depend on how rows are dealt.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() > cores or rows.count() < cores * ROWS_PER_CORE:
        return rows
    return rows.repartition(cores)


def train(name, rows, invalid="error"):
    """Fit one configuration."""
    return _fit(name, spread(rows), invalid)


def _fit(name, rows, invalid):
    return pipeline(name, invalid).fit(rows)


def score(model, frame):
    """Model columns on a batch or a stream."""
    return model.transform(frame)


def label_scores(scored):
    """Class code, label and the three probabilities as plain columns."""
    return scored.withColumns(
        {
            "prediction_label": class_label(F.col("prediction").cast("int")),
            **{name: class_probability(F.col("probability"), index) for index, name in enumerate(PROBABILITIES)},
        }
    )


def feature_importance(spark, model):
    """Feature and weight of a tree model."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double")


def evaluate(model, rows):
    """Confusion matrix of a model; all metrics follow from it."""
    return confusion_matrix(model.transform(rows))


def fit_all(names, rows, invalid="error", at_once=FITS_AT_ONCE):
    """Each named configuration fitted on the same rows: name to model and seconds.

    Up to ``at_once`` fits run side by side, each in a scheduler pool of its own, so that short
    ones are not held up where the scheduler is fair. A fit alone leaves most of a cluster idle
    between its many small jobs. Seconds are those of the clock, with whatever ran beside.

    A forest keeps four bytes for each row and tree while it is fitted. Where the rows have a part
    for every core it fills the cluster alone, so forests then wait for each other and at most
    the largest is in memory.
    """
    context = rows.sparkSession.sparkContext
    forests_at_once = at_once if rows.rdd.getNumPartitions() < context.defaultParallelism else 1
    turn = BoundedSemaphore(max(1, forests_at_once))

    def fit(name):
        context.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        with turn if name in RANDOM_FORESTS else nullcontext():
            began = time.perf_counter()
            return _fit(name, rows, invalid), time.perf_counter() - began

    names = list(names)
    with ThreadPoolExecutor(max(1, min(at_once, len(names)))) as threads:
        fitted = [threads.submit(inheritable_thread_target(rows.sparkSession)(fit), name) for name in names]
        return {name: job.result() for name, job in zip(names, fitted)}


def confusion_of_all(models, rows, label="label"):
    """One confusion matrix for all models (name to model), in one pass over the rows: model,
    label, prediction, count."""
    for place, model in enumerate(models.values()):
        scored = model.transform(rows)
        added = [name for name in scored.columns if name not in rows.columns]
        rows = scored.withColumn(f"prediction of {place}", F.col("prediction")).drop(*added)
    told = [F.struct(F.lit(name).alias("model"), F.col(f"`prediction of {place}`").alias("prediction")) for place, name in enumerate(models)]
    told = rows.select(F.col(label).alias("label"), F.explode(F.array(*told)).alias("told"))
    return told.select("told.model", "label", "told.prediction").groupBy("model", "label", "prediction").agg(F.count("*").alias("count"))


def model_leaderboard(spark, train_rows, test_rows, names=None, invalid="error", save_to=None, at_once=FITS_AT_ONCE):
    """Fit the named configurations and compare them, one row each.

    The training rows are spread and kept while the models are fitted side by side; lost blocks are
    computed again. All models are judged in one pass over the test rows.
    """
    settings = configurations()
    train_rows = spread(train_rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = fit_all(names or settings, train_rows, invalid, at_once)
    finally:
        train_rows.unpersist()
    models = {name: model for name, (model, _) in fitted.items()}
    cells = confusion_of_all(models, test_rows)
    cells = spark.createDataFrame(cells.toArrow(), cells.schema)  # one row for each model and pair of classes
    rows = []
    for name, (model, seconds) in fitted.items():
        metrics = multiclass_metrics(cells.filter(F.col("model") == name)).first()
        if save_to:
            save_model(model, f"{save_to}/{name.lower()}")
        shown = {key: str(value) for key, value in settings[name].items() if key != "family"}
        rows.append((name, settings[name]["family"], shown, *[metrics[key] for key in _METRICS], seconds))
    schema = "model string, family string, settings map<string,string>, " + ", ".join(f"{key} double" for key in _METRICS)
    return spark.createDataFrame(rows, schema + ", training_seconds double").orderBy("family", "model")


def pick_model(leaderboard, metric="f1"):
    """The best row; equal scores go to the one that trained faster."""
    return leaderboard.orderBy(F.desc(metric), "training_seconds").limit(1)


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)
