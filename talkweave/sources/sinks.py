"""Writers: Parquet by shard, JSON documents, recipe files for speech toolkits, audio rows, Markdown."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, mode: str = "errorifexists", block_bytes: int | None = None, block_rows: int | None = None) -> None:
    """block_bytes, block_rows: what a row group holds at most (rows of audio are large, so few go into one)."""
    w = df.write.mode(mode)
    for name, value in (("parquet.block.size", block_bytes), ("parquet.block.row.count.limit", block_rows)):
        w = w.option(name, value) if value else w
    w.parquet(path)


def sharded(df: DataFrame, path: str, key: str = "shard") -> None:
    """One folder a shard; shards that are there already stay as they are."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        done = spark.read.schema(df.schema).parquet(path).select(F.col(key).cast("string").alias("_done")).distinct()
        df = df.join(done, F.col(key).cast("string") == F.col("_done"), "left_anti")
    df.repartition(key).write.mode("append").partitionBy(key).parquet(path)


def documents(df: DataFrame, keys: list[str], order: list[str], metadata: dict[str, Column], items: str = "speeches") -> DataFrame:
    """One row a key: metadata (keys and aggregates) and the rows in order, as structs."""
    fields = [c for c in df.columns if c not in keys]
    rows = F.sort_array(F.collect_list(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)), F.struct(*fields).alias("_row"))))
    grouped = df.groupBy(*keys).agg(F.transform(rows, lambda x: x["_row"]).alias(items), *(c.alias(n) for n, c in metadata.items()))
    return grouped.select(*keys, F.struct(*keys, *metadata).alias("metadata"), items)


def recording_documents(df: DataFrame, source: str) -> DataFrame:
    """Per recording, by time."""
    totals = {"number_of_speeches": F.count(F.lit(1)), "duration": F.sum("duration_segment"), "data_source": F.lit(source)}
    return documents(df, ["audio_file"], ["start_segment"], totals)


def protocol_documents(df: DataFrame) -> DataFrame:
    """Per protocol, by number."""
    return documents(df, ["protocol_id"], ["speech_number"], {"number_of_speeches": F.count(F.lit(1)), "dates": F.array_sort(F.array_distinct(F.flatten(F.collect_list("dates"))))})


def json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Nulls are written as null. by: a folder for each value."""
    w = df.write.mode("overwrite").option("ignoreNullFields", False)
    (w.partitionBy(by) if by else w).json(path)


def json_each(docs: DataFrame, path: str, key: str) -> None:
    """A JSON document a row, one file each, named after the key, whose values are unique."""
    text_each(docs.select(F.col(key), F.to_json(F.struct("*")).alias("value")), path, key)


def text_each(rows: DataFrame, path: str, key: str) -> None:
    """The value of each row in a file of its own, named after the key, whose values are unique.

    Spark's writer takes a commit, and on a local file system two processes for permissions, a file. In a folder of such a
    system, which all executors share, their Python writes the files: whole under another name, then renamed, so that a task
    may run again. Elsewhere the tasks put Spark's files in place themselves, and not the driver one by one.
    """
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.getScheme() != "file":
        rows.select("value").write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
        return
    folder = at.toUri().getPath()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        os.makedirs(folder, exist_ok=True)
        for part in parts:
            for k, text in zip(*(c.to_pylist() for c in part.columns)):
                name = "none" if k is None else "doc-" + quote(k, safe="")
                name = name if len(name) <= 200 else "long-" + hashlib.sha256(k.encode()).hexdigest()
                begun = f"{folder}/.{uuid.uuid4().hex}"  # Spark reads no file whose name begins with a dot
                with open(begun, "w", encoding="utf-8", newline="") as f:
                    f.write(text + "\n")
                os.replace(begun, f"{folder}/{name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    fs.mkdirs(at)
    rows.select(F.col(key).cast("string").alias("k"), F.coalesce("value", F.lit("")).alias("value")).mapInArrow(run, "n long").agg(F.sum("n")).collect()


def kaldi(segments: DataFrame, path: str) -> None:
    """wav.scp, segments and text in folders below the path; recordings reco001.., segments seg001-0001.. in order. Recordings
    are numbered in one task (one row each), segments within their recording."""
    from pyspark.sql import Window

    files = segments.select("file").distinct().withColumn("_r", F.row_number().over(Window.orderBy("file")))
    s = segments.join(files, "file").withColumn("_s", F.row_number().over(Window.partitionBy("file").orderBy("start", "end")))
    reco, seg = F.format_string("reco%03d", "_r"), F.format_string("seg%03d-%04d", "_r", "_s")
    lines = {
        "wav.scp": files.select(F.concat_ws(" ", reco, "file").alias("value")),
        "segments": s.select(F.concat_ws(" ", seg, reco, F.format_string("%.2f", "start"), F.format_string("%.2f", "end")).alias("value")),
        "text": s.select(F.concat_ws(" ", seg, "text").alias("value")),
    }
    for name, df in lines.items():
        df.write.mode("overwrite").text(f"{path}/{name}")


def vocabulary(df: DataFrame, path: str) -> None:
    """`id word` lines."""
    df.select(F.concat_ws(" ", F.col("id").cast("string"), "word").alias("value")).write.mode("overwrite").text(path)


def read_vocabulary(spark, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_extract("value", r"^(\d+) (.*)$", 2).alias("word"), F.regexp_extract("value", r"^(\d+) (.*)$", 1).cast("long").alias("id"))


def wav_bytes(rate: int = 16_000):
    """Arrow UDF: samples in -1..1 -> 16-bit WAV file."""
    import io
    import wave

    import numpy as np

    @F.pandas_udf("binary")
    def udf(audio: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            out = io.BytesIO()
            with wave.open(out, "wb") as w:
                w.setnchannels(1)
                w.setsampwidth(2)
                w.setframerate(rate)
                w.writeframes((np.clip(np.asarray(x), -1, 1) * 32767).astype("<i2").tobytes())
            return out.getvalue()

        return audio.map(one)

    return udf


def npy_files(df: DataFrame, folder: str, file: str = "file", name: str = "speech_id", shape: str = "shape", values: str = "values") -> DataFrame:
    """Writes {folder}/{file}/{name}.npy for each row into a folder that all executors share; returns the paths. A file is
    written aside and renamed, so a task that is tried again, or twice at once, leaves whole files only."""
    import os
    import uuid
    from collections.abc import Iterator

    import numpy as np

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            paths = []
            for f, n, s, v in zip(part["f"], part["n"], part["s"], part["v"]):
                path = os.path.join(folder, f, f"{n}.npy")
                os.makedirs(os.path.dirname(path), exist_ok=True)
                aside = f"{path}.{uuid.uuid4().hex}"
                with open(aside, "wb") as out:
                    np.save(out, np.asarray(v, "float32").reshape(list(s)))
                os.replace(aside, path)
                paths.append(path)
            yield pd.DataFrame({"path": paths})

    return df.select(F.col(file).cast("string").alias("f"), F.col(name).cast("string").alias("n"), F.col(shape).alias("s"), F.col(values).alias("v")).mapInPandas(run, "path string")


def markdown(df: DataFrame, most_rows: int = 1000, decimals: int = 2) -> str:
    """A small result as a Markdown table; larger ones raise."""
    rows = df.limit(most_rows + 1).collect()
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    show = lambda x: f"{x:.{decimals}f}" if isinstance(x, float) else "" if x is None else str(x)
    head = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    return "\n".join(head + [f"| {' | '.join(show(v) for v in r)} |" for r in rows])
