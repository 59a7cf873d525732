"""Session settings and shipping of the package to executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build(master: str = "local[*]", name: str = "noticelake", **more: str) -> SparkSession:
    """A session for local work: UTC, ANSI on, adaptive plans. On a cluster spark-submit sets these."""
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"} | more
    return SparkSession.builder.master(master).appName(name).config(map=conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application, so that their workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "noticelake.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which driver and executors share.

    A temporary folder is set only where the setting is missing and the master is
    local; on a cluster other machines could not read it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="noticelake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"
