"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the results depend on, plus adaptive execution. Sizes (shuffle
# partitions, memory, advisory partition bytes) belong to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Timers need this store; its state is on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "feedmetrics", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session may run without the setting and gets a folder of its own;
    on a cluster a missing setting is an error, since a machine-local folder
    would be lost with its machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.mkdtemp(prefix="feedmetrics-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Removes a folder made under ``scratch_dir``, once nothing reads it any more."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def run_together(spark: SparkSession, actions: Iterable[Callable], at_once: int = 8) -> list:
    """Runs independent Spark actions at the same time; results in order.

    Several tables of a run are small next to the cluster. One after the other
    each would leave most executors idle; submitted together they share them.
    The first error is raised once all have ended.
    """
    with ThreadPoolExecutor(at_once) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [future.result() for future in futures]
