"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

from vantagrid.errors import ConfigRefused


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names; where it names none, in a local one if driver and executors are one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ConfigRefused("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="vantagrid-")
    return f"{_qualified(spark, root).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _qualified(spark: SparkSession, root: str) -> str:
    """A folder as a URI with its store: without one it is the default file system's, as Spark itself takes it."""
    if urlparse(root).scheme not in ("", "file"):
        return root
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", uri)
