"""Where queries that write leave their files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name in the shared folder the cluster names for checkpoints.

    Where none is named and the session is a local one, a folder of this machine does.
    """
    shared = spark.conf.get(_SETTING, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/barloom-{uuid.uuid4().hex}"
