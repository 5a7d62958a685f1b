"""Session defaults and run-wide constants."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import SparkSession

# Fixed values of the data model: the open-end sentinel of a validity period and
# the size of the date repair applied by staging.
OPEN_END = dt.date(9999, 1, 1)
SHIFT_YEARS = 18

# One explicit "now" for a whole run (the original views evaluate now() per query).
AS_OF_DEFAULT = dt.date(2020, 12, 31)

# Keys with more rows are cut into time slices of about so many rows (sequence
# windows and the interval-overlap join).
HEAVY_ROWS = 20_000


def session(master: str | None = None, shuffle_partitions: int | None = None,
            app: str = "paytrail") -> SparkSession:
    """Build (or reuse) a session with the settings this package relies on.

    AQE stays on: it coalesces small shuffle partitions, turns sort-merge joins
    into broadcast joins only after measuring the small side, and splits skewed
    join partitions.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if os.environ.get("PAYTRAIL_DRIVER_MEMORY"):
        conf["spark.driver.memory"] = os.environ["PAYTRAIL_DRIVER_MEMORY"]
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only in a local session (tests) without the setting a private scratch folder
    is created and registered, so that ``DataFrame.checkpoint()`` works as well.
    On a cluster a machine-local folder would lose files, so this raises there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="paytrail-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
