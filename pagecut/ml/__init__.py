"""Spark ML: features to vectors, scaling, training, tuning, scoring."""
