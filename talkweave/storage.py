"""Tables in the folder that all executors share: what has to be computed once, whatever executor is lost later."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a local session gets a temporary one; a cluster, whose
    machines don't share such a folder, an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="talkweave-")
        atexit.register(shutil.rmtree, named, True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends here and no executor's loss can undo it.

    The folder goes when the driver ends, or earlier by `dropped`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    got._stored_at = path
    _ENDS.add(path, spark)
    return got


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._stored_at)
        _ENDS.paths.pop(df._stored_at, None)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


class _Ends:
    """Deletes what is still there when the driver ends normally."""

    def __init__(self):
        self.paths: dict[str, weakref.ref] = {}
        atexit.register(self.clear)

    def add(self, path: str, spark: SparkSession) -> None:
        self.paths[path] = weakref.ref(spark)

    def clear(self) -> None:
        for path, ref in self.paths.items():
            spark = ref()
            try:
                if spark is not None and spark.sparkContext._jsc is not None:
                    _delete(spark, path)
            except Exception:  # noqa: BLE001, S112 - the session has ended before: its folder is left to its owner
                continue


_ENDS = _Ends()
