"""orderloom: order-lifecycle analytics expressed as plain PySpark.

Every operator is a function over DataFrames. Spark plans, partitions and runs
the work; nothing here schedules, parses or executes queries by itself.
"""

from orderloom.session import build_session, work_area

__all__ = ["build_session", "work_area"]
