"""Training, comparing and applying the classifiers, on Spark ML."""
