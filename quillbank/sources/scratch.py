"""A folder that driver and executors share, for files that a job writes on the way."""

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder inside the one that spark.checkpoint.dir names.

    Where the session names none, a local session gets a temporary folder, which goes with the process, and any
    other one a folder inside the warehouse, which a cluster shares.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not shared and (master == "local" or master.startswith("local[")):
        shared = tempfile.mkdtemp(prefix="quillbank-files-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared or spark.conf.get('spark.sql.warehouse.dir')}/files-{uuid4().hex}"
