"""Class probabilities out of a model's probability vector, without a Python worker."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def class_probability(probability, index):
    """Element ``index`` of the vector; 0.0 where there is no vector."""
    return F.when(probability.isNotNull(), vector_to_array(probability)[index]).otherwise(F.lit(0.0))
