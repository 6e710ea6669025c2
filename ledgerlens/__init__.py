"""ledgerlens: order-line sales analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is
built only from Spark's own DataFrame / SQL functions, so Catalyst plans it,
pushes filters and column pruning into the Parquet scan, and runs it with
whole-stage code generation.  Nothing in the core collects to the driver.
"""

from ledgerlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
