"""Scratch folders that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def new_scratch_dir(spark: SparkSession, purpose: str = "scratch") -> str:
    """A fresh folder name under the shared folder named in ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only where that setting is absent and the
    session runs in local mode, as in tests; on a cluster the setting is required.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="asterloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
