"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What is left to delete, by path.
_written: dict[str, tuple] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. A folder of this machine stands in where it is unset, but only if all runs on this machine."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isEmpty():
        return sc._jsc.sc().getCheckpointDir().get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(folder)
    return folder


def reliable(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and cut from its lineage. It is deleted by release(), or when Python ends."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    out = df.checkpoint(eager=True)
    path = _path(out)
    if path is not None:
        delete_at_exit(sc, path)
    return out


def tabled(df: DataFrame) -> DataFrame:
    """df, written to the shared folder as Parquet and read again; deleted as what reliable() writes.

    For loops: a checkpoint hands on the optimizer's estimate of its size, which joins multiply round by round until it stops the
    optimizer; a table is as large as its files.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    delete_at_exit(spark.sparkContext, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tallyframe_path = path
    return out


#: Rows up to which a table of members is copied to all executors.
BESIDE = 1_000_000


def beside(members: DataFrame, most: int = BESIDE) -> DataFrame:
    """members, written once and copied to each executor, unless there are very many: a join with their pairs, of which there are far more, then moves none of these."""
    members = reliable(members)
    return F.broadcast(members) if members.count() <= most else members


def release(*frames: DataFrame) -> None:
    """Delete what reliable() or tabled() wrote for these frames. Nothing that is still to be computed may read them."""
    for df in frames:
        path = getattr(df, "_tallyframe_path", None) or _path(df)
        if path is not None:
            delete(df.sparkSession.sparkContext, path)


def delete(sc: SparkContext, path: str) -> None:
    _delete(sc._jvm, sc._jsc.hadoopConfiguration(), path)
    _written.pop(path, None)


def delete_at_exit(sc: SparkContext, path: str) -> None:
    _written[path] = (sc._jvm, sc._jsc.hadoopConfiguration())


def _path(df: DataFrame) -> str | None:
    plan = df._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return None
    file = plan.rdd().getCheckpointFile()
    return file.get() if file.isDefined() else None


def _delete(jvm, conf, path: str) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


@atexit.register
def _delete_all() -> None:
    for path, (jvm, conf) in _written.items():
        try:
            _delete(jvm, conf, path)
        except Exception:  # noqa: BLE001 - the JVM has gone, so nothing can be deleted any more
            return
