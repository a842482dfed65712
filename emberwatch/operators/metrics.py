"""Classification quality as ordinary aggregates."""

from pyspark.sql import functions as F


def class_distribution(frame, label="label"):
    return frame.groupBy(label).agg(F.count("*").alias("count")).orderBy(label)


def confusion_matrix(frame, label="label", prediction="prediction"):
    return (
        frame.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("count"))
        .orderBy("label", "prediction")
    )


def class_errors(confusion):
    """The wrong cells of a confusion matrix."""
    return confusion.filter(F.col("label") != F.col("prediction"))


def row_counts(frame, **parts):
    """Rows of ``frame``, and of its named parts (conditions), in one pass."""
    counts = frame.agg(F.count("*").alias("all"), *[F.count_if(condition).alias(name) for name, condition in parts.items()])
    rows = [F.struct(F.lit(name).alias("frame"), F.col(name).alias("rows")) for name in ["all", *parts]]
    return counts.select(F.inline(F.array(*rows)))


def multiclass_metrics(confusion):
    """Accuracy and label-weighted precision, recall and F1 out of a confusion matrix.

    The matrix has one row per pair of classes, so all four metrics cost a single pass
    over the predictions, the one that built it.
    """
    cell = F.explode(
        F.array(
            F.struct(F.col("label").cast("double").alias("class"), F.col("count").alias("actual"), F.lit(0).cast("bigint").alias("predicted")),
            F.struct(F.col("prediction").cast("double").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("count").alias("predicted")),
        )
    )
    hit = F.when(F.col("label").cast("double") == F.col("prediction").cast("double"), F.col("count")).otherwise(F.lit(0))
    cells = confusion.select(hit.alias("hit"), cell.alias("cell")).select("hit", "cell.*")
    classes = cells.groupBy("class").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum(F.when(F.col("actual") > 0, F.col("hit")).otherwise(F.lit(0))).alias("hits"),
    )
    zero = F.lit(0.0)
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(zero)
    recall = F.when(F.col("actual") > 0, F.col("hits") / F.col("actual")).otherwise(zero)
    classes = classes.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(zero)
    total = F.sum("actual")

    def weighted(column):
        return F.sum(column * F.col("actual")) / total

    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(F.col("precision")).alias("precision"),
        weighted(F.col("recall")).alias("recall"),
    )
