"""The twelve candidate pipelines."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler

from emberwatch.constants import DECISION_TREES, FEATURES, LOGISTIC_REGRESSIONS, RANDOM_FORESTS, SEED

_LABEL, _FEATURES, _RAW = "label", "features", "raw_features"


def assembler(output=_FEATURES, invalid="error"):
    """Five measures to one vector. Null or NaN fails; ``invalid='skip'`` leaves such rows out."""
    return VectorAssembler(inputCols=FEATURES, outputCol=output, handleInvalid=invalid)


def scaler():
    return StandardScaler(inputCol=_RAW, outputCol=_FEATURES, withMean=True, withStd=True)


def random_forest(trees, depth):
    return RandomForestClassifier(labelCol=_LABEL, featuresCol=_FEATURES, numTrees=trees, maxDepth=depth, seed=SEED)


def decision_tree(depth, instances):
    return DecisionTreeClassifier(
        labelCol=_LABEL, featuresCol=_FEATURES, maxDepth=depth, minInstancesPerNode=instances, seed=SEED
    )


def logistic_regression(iterations, regularisation, elastic):
    return LogisticRegression(
        labelCol=_LABEL, featuresCol=_FEATURES, family="multinomial",
        maxIter=iterations, regParam=regularisation, elasticNetParam=elastic,
    )


def configurations():
    """Settings by model name, in the order they are compared."""
    named = {}
    for name, (trees, depth) in RANDOM_FORESTS.items():
        named[name] = {"family": "random forest", "trees": trees, "depth": depth}
    for name, (depth, instances) in DECISION_TREES.items():
        named[name] = {"family": "decision tree", "depth": depth, "instances": instances}
    for name, (iterations, regularisation, elastic) in LOGISTIC_REGRESSIONS.items():
        named[name] = {
            "family": "logistic regression",
            "iterations": iterations, "regularisation": regularisation, "elastic": elastic,
        }
    return named


def pipeline(name, invalid="error"):
    """The unfitted pipeline of one configuration. Only logistic regression scales its features."""
    if name in RANDOM_FORESTS:
        return Pipeline(stages=[assembler(invalid=invalid), random_forest(*RANDOM_FORESTS[name])])
    if name in DECISION_TREES:
        return Pipeline(stages=[assembler(invalid=invalid), decision_tree(*DECISION_TREES[name])])
    return Pipeline(stages=[assembler(_RAW, invalid), scaler(), logistic_regression(*LOGISTIC_REGRESSIONS[name])])
