"""Session defaults and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master=None, app_name="review-lens", **conf):
    """A session with the settings the jobs expect; `conf` keys use __ for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark, purpose):
    """A new folder, visible to every executor, for tables that cut a lineage.

    The cluster names the shared folder in `spark.checkpoint.dir`. Only a local
    session may go without it, since there all tasks see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="review-lens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove(spark, path):
    """Delete a file or folder in whatever store it is; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def children(spark, path):
    """Names of what is in a folder, in whatever store it is; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_text(spark, path, text):
    """Write a small file, which appears whole or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = hadoop(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    fs.rename(draft, target)
