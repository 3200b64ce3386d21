"""Places for intermediate tables, checkpoints and topic logs of one run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="eventweir-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder named by ``spark.checkpoint.dir``.

    Only on a local master may that setting be absent: a temporary folder, removed when the
    process ends, takes its place. Elsewhere each executor would write to its own disk, so
    an absent setting is an error. The session's settings are left as they are.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table through the file system that its path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
