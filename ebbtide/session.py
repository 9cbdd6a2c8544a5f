"""Shared folders for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    The session's ``spark.checkpoint.dir`` decides. Only a local master, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ebbtide-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and go on from the stored rows.

    Needed where later steps must see exactly the rows of an earlier one, for
    example a row numbering, even after executors have been lost.
    """
    spark = df.sparkSession
    shared_folder(spark)
    return df.checkpoint(eager=True)
