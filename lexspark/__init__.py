"""Legal-document ingestion and retrieval on Spark, and operators for training data."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable by the session's Python workers (once for each application).

    Where the session sets no size of Arrow batches, one of 2,000 rows is set: whole texts may be long.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, "2000")
    if getattr(sc, "_lexspark_shipped", None) != sc.applicationId:
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "lexspark.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(top):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("lexspark", os.path.relpath(full, top)))
        sc.addPyFile(path)
        sc._lexspark_shipped = sc.applicationId
    return spark
