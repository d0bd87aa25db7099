"""Session set-up shared by tests, the bench and scripts."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Session setting: partitions that inputs of heavy text work are spread over.  Unset, nothing is spread.
INPUT_PARTITIONS = "spark.quirespark.inputPartitions"


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, memory: str = "12g") -> SparkSession:
    """A local session with the settings the engine is tuned for.

    On a cluster the caller brings its own session; nothing in the library
    overrides settings that are already there.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quirespark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(INPUT_PARTITIONS, str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as the session setting ``INPUT_PARTITIONS`` says; unset, as it is read.

    For single files of one row group, as in the bench, which would else keep one
    core busy.  The size of the input plays no part in it.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; on a cluster, where
    executors would not share it, that is an error.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quirespark-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return named
