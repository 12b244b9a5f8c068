"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_spark(master: str | None = None, app: str = "tabsmith",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings every query relies on (safe on an existing session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Long texts: a batch to Python is bounded by its bytes, not only its rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read here.
    When it is unset a private scratch folder is created once, but only where
    the driver and the executors are one process; a cluster must name one.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tabsmith-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


MAX_BROADCAST_ROWS = 100_000


def broadcast_small(df, most: int = MAX_BROADCAST_ROWS):
    """``df``, marked for broadcast if it has no more rows than ``most``."""
    return F.broadcast(df) if df.count() <= most else df


ROWS_PER_PARTITION = 10_000
LEARNER_ROUNDS = 2
MOST_ROWS_PER_PARTITION = 1_000_000


def learner_partitions(spark: SparkSession, n_rows: int) -> int:
    """Partitions for rows that a learner reads again and again: as many as the rows need,
    from there on whole rounds of the cores.  Tasks of a round, and what they send to the
    driver, then don't grow with the rows until partitions reach their largest size."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    rounds = max(LEARNER_ROUNDS, -(-n_rows // (MOST_ROWS_PER_PARTITION * cores)))
    return max(1, min(-(-n_rows // ROWS_PER_PARTITION), rounds * cores))


def even(df, n_rows: int):
    """``df`` dealt in equal parts: ranks leave parts of uneven size, and a learner waits
    for the largest one in every round."""
    return df.repartition(learner_partitions(df.sparkSession, n_rows))


def storage_memory(spark: SparkSession) -> int:
    """Bytes that all executors together have for kept rows (the driver's, where it runs the tasks)."""
    sc = spark.sparkContext._jsc.sc()
    stores, driver = sc.getExecutorMemoryStatus(), sc.env().blockManager().blockManagerId().hostPort()
    found, names = {}, stores.keysIterator()
    while names.hasNext():
        name = names.next()
        found[name] = stores.apply(name)._1()
    return sum(most for name, most in found.items() if name != driver or len(found) == 1)


#: Folders of the steps under way (see ``scratch``), the innermost last.
_STEPS: list[str] = []


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh output location inside the shared checkpoint folder."""
    base = _STEPS[-1] if _STEPS else f"{checkpoint_dir(spark).rstrip('/')}/tabsmith-out"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession):
    """What is written to ``output_path`` inside goes when the step is over.  Whatever
    is to stay must have been written elsewhere by then, to a path taken before."""
    _STEPS.append(output_path(spark, "step"))
    try:
        yield
    finally:
        discard(spark, _STEPS.pop())


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``output_path`` gave."""
    if "/tabsmith-out/" not in path:
        raise ValueError(f"not a folder of this library: {path}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any store that Spark reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def is_local_path(p: str) -> bool:
    return p.startswith("/") or p.startswith("file:")


def ensure_local_parent(p: str) -> None:
    if p.startswith("/"):
        os.makedirs(os.path.dirname(p), exist_ok=True)


def materialize(df, name: str):
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts a long lineage (e.g. several ranks feeding several consumers) so
    later stages and statistics read the rows once; a lost executor re-reads
    the files instead of recomputing the chain.
    """
    spark = df.sparkSession
    path = output_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
