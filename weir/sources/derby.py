"""The database that Spark brings. It lives in the driver, where no task can reach it: it loads files that tasks wrote, and tasks read it packed."""

from __future__ import annotations

import os
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from weir.sources.scratch import scratch

PROPERTIES = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
#: How it loads a file, for write_table and load_once.
IMPORT = "CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table}', '{file}', ',', '\"', 'UTF-8', 0)"


def new_database(spark: SparkSession) -> str:
    """The URL of a new database, for the driver alone, in a folder that all share; that must be one of the file system."""
    folder = scratch(spark)
    if not folder.startswith(("file:", "/")):
        raise ValueError(f"{folder}: Derby keeps its files in a file system")
    folder = "/" + folder.removeprefix("file:").lstrip("/")
    os.makedirs(folder)
    return f"jdbc:derby:{folder}/db;create=true"


def packed(spark: SparkSession, url: str) -> str:
    """Closes the database and packs it; the URL by which any number of tasks, wherever they run, read it as it is now."""
    base = url.partition(";")[0]
    folder = base.removeprefix("jdbc:derby:")
    try:
        spark._jvm.java.sql.DriverManager.getConnection(f"{base};shutdown=true")
    except Py4JJavaError as e:  # a database that closes says so by this state
        if e.java_exception.getSQLState() != "08006":
            raise
    jar = f"{folder}.jar"
    with zipfile.ZipFile(jar, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(folder):
            for n in names:
                z.write(f"{at}/{n}", os.path.relpath(f"{at}/{n}", os.path.dirname(folder)))
    return f"jdbc:derby:jar:({jar})db"
