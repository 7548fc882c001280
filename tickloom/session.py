"""Session settings and the shared folder for written intermediate results."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="tickloom", master=None, shuffle_partitions=None, **conf):
    """A session with the settings the library is tuned for. On a cluster the submit
    command supplies the master and the partition count; AQE resizes the rest."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local session may
    go without one; it gets a temporary folder, since there is no other machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh_dir(spark, name):
    """A new folder name under the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
