"""Session settings the jobs are tuned for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job wants. Only session-level (mutable) settings are
# listed, so the same function serves a session somebody else has created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lives off-heap and spills to disk. Each batch uploads its
    # changes to the checkpoint folder, so a lost executor only costs a reload.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def cluster_settings(total_cores: int) -> dict[str, str]:
    """Start settings for a large cluster, for ``build(**cluster_settings(8000))``.

    Shuffles start with several partitions per core and AQE merges them to the
    advised size, so one setting serves small and very large stages. A streaming
    query keeps the partition number of its first start and is not merged: see
    :func:`for_streams`.
    """
    return {
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def for_streams(spark: SparkSession) -> SparkSession:
    """A session of its own for streaming queries, on the same cluster.

    Every state partition costs a task and a commit per batch, whatever it
    holds, so a stream gets at most one per core; batch jobs keep their number.
    """
    streams = tune(spark.newSession())
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    streams.conf.set("spark.sql.shuffle.partitions", str(min(wanted, cores)))
    return streams


def build(master: str | None = None, app: str = "footfall", **conf: str) -> SparkSession:
    """Create (or fetch) a tuned session; more settings as ``build(**{"spark.x.y": "z"})``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. In local mode, where driver
    and executors share one disk, a temporary folder is made when none is set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="footfall-")
    context.setCheckpointDir(made)
    return made


_roots: dict[tuple[str, str], str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses.

    All paths of an application lie in one folder, which is deleted when the application ends.
    """
    key = (spark.sparkContext.applicationId, shared_folder(spark))
    if key not in _roots:
        root = f"{key[1].rstrip('/')}/footfall-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _roots[key] = root
    return f"{_roots[key]}/{label}-{uuid.uuid4().hex}"


def ensure_checkpointing(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable without overriding a configured folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
