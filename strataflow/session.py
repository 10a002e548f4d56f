"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions for a shuffle of that size, about 256 MB each and at least one
    per core. AQE merges those that turn out small, but cannot add any."""
    wanted = -(-shuffled_bytes // PARTITION_BYTES)
    return max(wanted, cores)


def build_session(
    master: str | None = None,
    app: str = "strataflow",
    shuffled_bytes: int | None = None,
    cores: int = 1,
    **conf: str,
) -> SparkSession:
    """A session with the settings the library counts on; ``conf`` overrides.

    ``shuffled_bytes``, the largest shuffle to expect, sets the partitions AQE
    starts from; without it the cluster's own value stays.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A landing task writes one file: fewer and larger ones than by default.
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes, cores))
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary
    folder: on a cluster such a folder would exist on one machine alone.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/") + "/strataflow"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="strataflow-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on whatever file system the path names."""
    target, system = _file_system(spark, path)
    return system.delete(target, True)


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if there is one."""
    target, system = _file_system(spark, path)
    system.mkdirs(target.getParent())
    return system.createNewFile(target)


def list_folder(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names in a folder that end so, none if there is no such folder."""
    target, system = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [name for s in system.listStatus(target) if (name := s.getPath().getName()).endswith(suffix)]
