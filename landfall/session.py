"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None


def build_session(name: str = "landfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Stamps are wall-clock times, so the zone is UTC. Partition counts are left to adaptive
    execution; ``conf`` overrides anything.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def on_workers(spark: SparkSession) -> None:
    """Let Python workers of this machine find the package where it is not installed but only on the driver's path.

    On a cluster it has to be installed on the executors, or sent there by ``addPyFile``.
    """
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a session known to be local may fall back to a machine-local folder; on a cluster such a folder would be
    invisible to the other machines. What is written there stays until ``remove_scratch`` is called.
    """
    global _LOCAL_SCRATCH
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", None) or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if _LOCAL_SCRATCH is None:
            _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="landfall-")
        root = _LOCAL_SCRATCH
    return os.path.join(root, "landfall", f"{label}-{uuid.uuid4().hex}")


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a path that ``scratch_path`` gave. Frames that read it can't be used afterwards. Returns whether it was there."""
    if "/landfall/" not in path:
        raise ValueError(f"{path} is not a scratch path")
    return delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds. Returns whether it was there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder_is_empty(spark: SparkSession, path: str) -> bool:
    """Whether a folder is absent or holds nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return not system.exists(place) or len(system.listStatus(place)) == 0
