"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in this package assumes.  Shuffle partition counts and
# memory stay with the deployment.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Text rows differ a thousandfold in length, so Arrow batches are bounded in bytes
# rather than left at Spark's 64 MB: a batch is held by the JVM and by its worker.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))

TASK_ROWS = 1 << 19  # rows that one task sorts or groups, where tasks are dealt by ``spread``

_SHIPPED: set[str] = set()


def local_session(app: str = "tastegrid", cores: int | str = "*",
                  shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in Python workers are sent by name, so the workers must be
    able to import the package wherever the driver was started.  An archive of it
    is put into the shared folder, from where Spark hands it to the executors.
    The size of Arrow batches is set as well where the session leaves it open.
    """
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, f"{home.name}/{file.relative_to(home)}")
    path = f"{scratch_path(spark, 'package')}/tastegrid-package.zip"
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(context._jsc.hadoopConfiguration()).create(where)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder reliable checkpoints and scratch tables go to.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder, because there every task sees it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastegrid-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_root(spark)}/tastegrid/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage reliably: the rows survive the loss of any executor."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def task_slots(spark: SparkSession) -> int:
    """How many tasks the session can run at once."""
    return max(1, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal about ``rows`` rows by ``keys`` to tasks of about ``TASK_ROWS`` each.

    The session's shuffle partitions do not rise with the tables, so what a task
    sorts or groups would.  Few rows stay as they are.
    """
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(tasks, *keys) if tasks > task_slots(df.sparkSession) else df
