"""Where registered queries put the tables, landing files and checkpoints they write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from millrace.sources.tables import ensure_namespace


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name on storage that every executor reaches.

    It lies in the session's ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def scratch_namespace(spark: SparkSession) -> str:
    """A new namespace of the session catalog whose tables lie in a scratch folder."""
    folder = scratch_folder(spark)
    namespace = f"run_{folder.rsplit('/', 1)[1]}"
    ensure_namespace(spark, namespace, f"{folder}/tables")
    return namespace
