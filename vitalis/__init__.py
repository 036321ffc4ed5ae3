"""vitalis: Spark-native preparation, profiling, modelling and monitoring of
coded survey visits and short texts.

Sub-packages
------------
sources    table scans, derived fixture views, file sources and sinks
functions  column expressions (text template, hashing, tokens, formats)
operators  cleaning, joins, profiling, analytics, split, gates, features,
           models, evaluation, scoring and report tables
streaming  event-time monitoring (batch and Structured Streaming forms)
plans      the training-table build and the query registry
"""

from vitalis.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
