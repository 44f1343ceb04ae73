"""Session helpers shared by every operator: the shared folder, lineage cuts, table loading."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster without it is refused, because
    a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        made = tempfile.mkdtemp(prefix="assayer-")
        atexit.register(shutil.rmtree, made, True)
        named = f"file://{made}"
        spark.conf.set(CHECKPOINT_DIR, named)
    return named.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it again.

    Lost executors then cost a read, not a replay, and loops keep short plans. ``release`` deletes such a table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/assayer-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._assayer_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table behind a result of ``cut_lineage`` that no later plan reads."""
    path = getattr(df, "_assayer_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
