"""A fresh folder that the driver and all executors share."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """Under spark.checkpoint.dir. A folder is made only where none is set and there is one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='weir-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/scratch-{uuid.uuid4().hex}"
