"""pitlane: motorsport results analytics as Spark DataFrame transformations.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects built from
Catalyst expressions, so the same code runs on a laptop sample or a cluster.
"""

from pitlane.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
