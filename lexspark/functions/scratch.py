"""A place for a query's own files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the cluster's shared checkpoint folder; a temporary one where none is set and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster's intermediate tables need a shared folder")
    return f"{(base or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/lexspark/{name}-{uuid.uuid4().hex}"
