"""quarry: training-data curation as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` expressions, joins, aggregations and windows, so
Catalyst plans and Tungsten executes the work. Arrow (``mapInArrow``) is used
only where a per-row numeric kernel has no built-in equivalent.
"""

from quarry.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
