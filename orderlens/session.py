"""Session settings and the shared scratch area."""

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rebalanced writes aim for files of this order.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


#: Shuffle partitions start out this small, of which adaptive execution merges but
#: never divides any.
PARTITION_MB = 128


def initial_partitions(data_gb):
    """Shuffle partitions to start with for an input of that size: 800,000 at 100 TB."""
    return max(200, round(data_gb * 1024 / PARTITION_MB))


def get_session(app_name="orderlens", master=None, data_gb=None, **settings):
    """A session with the library's settings; keyword settings win.

    ``data_gb`` is the rough size of the input. Without it shuffles start with Spark's
    200 partitions, enough for some tens of gigabytes.
    """
    if data_gb:
        name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings.setdefault(name, str(initial_partitions(data_gb)))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs = {}
_announced = set()


def _remove_at_end(spark, path):
    """Have Spark's file system delete a folder when the driver ends."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)  # only what exists can be marked
    files.deleteOnExit(hadoop)


def workspace(spark):
    """Shared folder of this application for tables written along the way.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    used only in local mode, where driver and executors are one process. What the
    application wrote there is deleted when its driver ends.
    """
    app_id = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app_id not in _local_dirs:
            _local_dirs[app_id] = tempfile.mkdtemp(prefix="orderlens-")
        base = _local_dirs[app_id]
    path = f"{base.rstrip('/')}/orderlens/{app_id}"
    if app_id not in _announced and hasattr(spark.sparkContext, "_jvm"):
        _announced.add(app_id)
        _remove_at_end(spark, _local_dirs.get(app_id, path))
    return path
