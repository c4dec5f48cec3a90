"""Where intermediate tables go: the shared folder the cluster names, never a local disk."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _own_folder() -> str:
    """One temporary folder per process."""
    return tempfile.mkdtemp(prefix="strata-")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path no earlier call has returned, under ``spark.checkpoint.dir``.

    Without that setting a temporary folder serves, but only where one machine
    runs everything.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
        root = _own_folder()
    return f"{root.rstrip('/')}/strata/{purpose}-{uuid.uuid4().hex}"
