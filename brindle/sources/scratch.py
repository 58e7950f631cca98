"""Where intermediate files go: a folder that the driver and all executors share."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """One folder of this machine for all local sessions of this process."""
    return "file://" + tempfile.mkdtemp(prefix="brindle-")


@lru_cache(maxsize=16)
def _warn_if_local(shared: str) -> None:
    if shared.startswith("file:"):
        logging.getLogger(__name__).warning("spark.checkpoint.dir is %s: it must be one file system that the driver and all executors have mounted", shared)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; in local mode, where that is unset, below one of this process.

    On a cluster it must be set: no executor would see what another wrote to a folder of its own machine. A ``file:`` path
    may be a mounted one, so it is taken, with a warning once.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    local = re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", ""))
    if not shared and not local:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if shared and not local:
        _warn_if_local(shared)
    return f"{(shared or _local_folder()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
