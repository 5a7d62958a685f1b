"""paytrail: workforce-history analytics on Spark.

Employment records kept as slowly changing dimensions (rows valid over
``[from_date, to_date]`` with an open end) are staged, profiled, reduced to a
current snapshot, aggregated into dashboards and benchmarks, and expanded into
a per-employee event history.  Every step is a DataFrame transformation.  The
actions are the writes of stored tables (staging, manager periods, benchmarks) and one
count per input that looks for heavy keys; both run once per application.
"""

from paytrail.config import AS_OF_DEFAULT, OPEN_END, session

__all__ = ["AS_OF_DEFAULT", "OPEN_END", "session"]
