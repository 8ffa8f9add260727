"""quadrant: a Spark-native media catalogue, transcript and label-indexing engine.

Everything is a DataFrame plan: catalogue graphs are quad tables, transcripts are
segment tables, classification is a pluggable stage over (text, vocabulary chunk)
pairs, and publishing is a batched, idempotent sink.
"""

from quadrant.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
