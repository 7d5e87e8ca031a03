"""salesflow: Spark-native sales analytics, data quality, feature and model-monitoring operators.

Every operator takes and returns a lazy ``DataFrame``. Fit steps return small
fitted-state objects (a handful of scalars per column) and run exactly one
aggregation job; everything data-sized stays on the executors.
"""

from salesflow.session import checkpoint_dir, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path"]
