"""Readers. Every one has a declared schema; files are listed and split by Spark."""

from __future__ import annotations

import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


#: Tasks, for each core, that read files of one document at most.
TASKS_A_CORE = 8


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file. Spark would have a task for a few files (each counts as 4 MB); a task takes many."""
    return spark.read.schema(schema).json(path, multiLine=True, recursiveFileLookup=True).coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def vad_documents(spark: SparkSession, path: str) -> DataFrame:
    return json_documents(spark, path, schemas.VAD)


def transcribed_documents(spark: SparkSession, path: str) -> DataFrame:
    return json_documents(spark, path, schemas.TRANSCRIBED)


def diarization_documents(spark: SparkSession, path: str) -> DataFrame:
    return json_documents(spark, path, schemas.DIARIZATION)


def protocol_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries under the root key, one a file, with or without a byte-order mark; empty strings are null."""
    flat = json_documents(spark, path, schemas.PROTOCOL_ENTRY).select("anforande.*")
    return flat.select(*(F.nullif(F.col(c), F.lit("")).alias(c) for c in flat.columns))


def web_speeches(spark: SparkSession, path: str) -> DataFrame:
    raw = json_documents(spark, path, schemas.WEB_SPEECH)
    return raw.withColumnsRenamed({"startpos": "start", "anf_sekunder": "duration"}).withColumns({"start": F.col("start").cast("double"), "duration": F.col("duration").cast("double"), "anf_nummer": F.col("anf_nummer").cast("long")})


def persons(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PERSONS).csv(path, header=True)


def segments(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Recognised segments, JSON lines or one array; words is the text split, rows in order of file and start."""
    rows = spark.read.schema(schemas.SEGMENT).json(path, multiLine=array)
    return rows.withColumn("words", F.filter(F.split(F.trim("text"), r"\s+"), lambda w: w != "")).orderBy("file", "start")


def ctm(spark: SparkSession, path: str) -> DataFrame:
    """(utt, channel, start_ms, end_ms, word) of whitespace columns utt channel start duration word."""
    c = F.split(F.trim("value"), r"\s+")
    ms = lambda x: F.bround(x.cast("double") * 1000).cast("long")
    return spark.read.text(path).where(F.size(c) >= 5).select(c[0].alias("utt"), c[1].alias("channel"), ms(c[2]).alias("start_ms"), (ms(c[2]) + ms(c[3])).alias("end_ms"), c[4].alias("word"))


def wav_scp(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_extract("value", r"^(\S+)\s+(.*)$", 1).alias("utt"), F.regexp_extract("value", r"^(\S+)\s+(.*)$", 2).alias("path"))


def listing(spark: SparkSession, path: str, glob: str = "*", least_bytes: int = 0) -> DataFrame:
    """(path, size, modified) of files in a folder and below; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")).where(F.col("size") >= least_bytes)


def in_years(files: DataFrame, first: int, last: int, path: str = "path") -> DataFrame:
    """Files whose path names a year of the range (first included, last not)."""
    year = F.regexp_extract(path, r"(?:^|\D)((?:19|20)\d{2})", 1)
    return files.where((year != "") & (F.try_to_number(year, F.lit("9999")) >= first) & (F.try_to_number(year, F.lit("9999")) < last))


def protocol_speeches(root: ET.Element) -> Iterator[dict]:
    """Speeches of a protocol: a speaker note opens one, utterances follow until one has no `next`. Text that a division leaves
    pending is dropped, as are speeches without an id."""
    name = lambda e: e.tag.rsplit("}", 1)[-1]
    xml_id = "{http://www.w3.org/XML/1998/namespace}id"
    dates = [d.get("when") for d in root.iter() if name(d) == "docDate" and d.get("when")]
    pos = 0
    for div in (e for e in root.iter() if name(e) == "div"):
        text, speaker, speech = [], None, None
        for e in div:
            if name(e) == "note" and "speaker" in e.attrib.values():
                speech = e.get(xml_id)
            elif name(e) == "u":
                speaker = e.get("who")
                text.append(" ".join(" ".join(e.itertext()).split()))
                if e.get("next") is None:
                    if speech is not None:
                        yield {"text": " ".join(text), "speaker_id": speaker, "speech_id": speech, "date": dates, "pos": pos}
                        pos += 1
                    text, speaker, speech = [], None, None


def protocols(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """Speeches of protocol files, in document order (pos); protocol_id is the file's name. Mixed content needs a parser that
    keeps order, so files are parsed in Python, one at a time. A file that can't be parsed gives one row with only its id."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for file, content in zip(part["path"], part["content"]):
                protocol = re.sub(r"\.[^.]*$", "", file.rsplit("/", 1)[-1])
                try:
                    rows += [s | {"protocol_id": protocol} for s in protocol_speeches(ET.fromstring(content))]
                except ET.ParseError:
                    rows.append({"text": None, "speaker_id": None, "speech_id": None, "protocol_id": protocol, "date": None, "pos": None})
            yield pd.DataFrame(rows, columns=["text", "speaker_id", "speech_id", "protocol_id", "date", "pos"], dtype=object).astype({"pos": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(run, schemas.SPEECH)


def speech_rows(speeches: DataFrame) -> DataFrame:
    """Numbered within the protocol, one row a candidate date (one without, where there is none)."""
    from pyspark.sql import Window

    numbered = speeches.where("speech_id IS NOT NULL").withColumn("speech_number", F.row_number().over(Window.partitionBy("protocol_id").orderBy("pos")))
    return numbered.withColumn("date", F.explode_outer("date")).withColumn("date", F.to_date("date"))


def fetched(ids: DataFrame, key: str, get: Callable[[str], str | None], tries: int = 3, backoff_s: float = 0.2) -> DataFrame:
    """(key, body, error) from a callable that fetches a document by id, tried again with growing pauses."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for k in part[key]:
                body = error = None
                for i in range(tries):
                    try:
                        body, error = get(k), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(backoff_s * 2**i)
                rows.append((k, body, error))
            yield pd.DataFrame(rows, columns=[key, "body", "error"])

    return ids.select(key).mapInPandas(run, f"`{key}` {dict(ids.dtypes)[key]}, body string, error string")


def emissions(spark: SparkSession, path: str, glob: str = "*.npy") -> DataFrame:
    """(path, shape, values) of saved float arrays."""
    import io

    import numpy as np

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            arrays = [np.load(io.BytesIO(c), allow_pickle=False) for c in part["content"]]
            yield pd.DataFrame({"path": part["path"], "shape": [list(a.shape) for a in arrays], "values": [a.astype("float32").ravel() for a in arrays]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInPandas(run, "path string, shape array<int>, values array<float>")


def resampled(x, rate: int, to: int):
    """Samples at another rate: band-limited by the lower of both rates, with a windowed sinc of 32 zero crossings."""
    import math

    import numpy as np

    if rate == to or not len(x):
        return np.asarray(x, "float32")
    common = math.gcd(rate, to)
    up, down = to // common, rate // common
    width = 32 * max(up, down)
    t = np.arange(-width, width + 1)
    kernel = np.sinc(t / max(up, down)) * np.kaiser(len(t), 9.0)
    kernel *= up / kernel.sum()
    # Output sample n lies at n * down of the up times finer grid; only the kernel's taps on given samples count.
    at = np.arange(-(-len(x) * up // down)) * down
    first = -(-(at - width) // up)
    taps = 2 * width // up + 1
    index = first[:, None] + np.arange(taps)
    offset = at[:, None] - index * up + width
    weight = np.where((offset >= 0) & (offset < len(kernel)), kernel[np.clip(offset, 0, len(kernel) - 1)], 0.0)
    inside = (index >= 0) & (index < len(x))
    return (weight * np.where(inside, np.asarray(x, float)[np.clip(index, 0, len(x) - 1)], 0.0)).sum(1).astype("float32")


def decoded_wav(content: bytes, rate: int | None = 16_000):
    """(rate, mono samples in -1..1) of a PCM WAV file of 8, 16, 24 or 32 bits, at `rate` if that is given."""
    import io
    import wave

    import numpy as np

    with wave.open(io.BytesIO(content)) as w:
        width, own, channels, raw = w.getsampwidth(), w.getframerate(), w.getnchannels(), w.readframes(w.getnframes())
    if width == 1:
        x = np.frombuffer(raw, np.uint8).astype(float) / 128 - 1
    elif width == 3:
        parts = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((parts[:, 0] | parts[:, 1] << 8 | parts[:, 2] << 16) << 8 >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}") / float(1 << 8 * width - 1)
    mono = x.reshape(-1, channels).mean(1)
    return (rate, resampled(mono, own, rate)) if rate else (own, mono.astype("float32"))


def decoded_audio(files: DataFrame, path: str = "path", content: str = "content", rate: int | None = 16_000) -> DataFrame:
    """(path, rate, audio, error) of WAV files in a binary column: mono samples in -1..1 at `rate` (None: the file's own). A
    file that can't be read has only its error."""
    import wave

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for file, held in zip(part["path"], part["content"]):
                try:
                    rows.append((file, *decoded_wav(held, rate), None))
                except (wave.Error, EOFError, ValueError, TypeError) as e:
                    rows.append((file, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "rate", "audio", "error"]).astype({"rate": "Int32"})

    return files.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(run, "path string, rate int, audio array<float>, error string")


def wav_audio(spark: SparkSession, path: str, glob: str = "*.wav", rate: int | None = None) -> DataFrame:
    """`decoded_audio` of the WAV files in a folder and below."""
    return decoded_audio(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path), rate=rate)


def coerced_list(json: str, item: str):
    """Column: array of a JSON text that holds one object of the schema `item`, or a list of them; null for other text."""
    return F.from_json(F.when(F.ltrim(json).startswith("["), F.col(json)).when(F.ltrim(json).startswith("{"), F.concat(F.lit("["), json, F.lit("]"))), f"array<{item}>")


def flattened(docs: DataFrame, list_column: str = "chunks", metadata: str = "metadata") -> DataFrame:
    """One row an element of the list (with its place, pos), with the document's metadata."""
    return docs.select(f"{metadata}.*", F.posexplode(list_column).alias("pos", "_e")).select("*", "_e.*").drop("_e")


def recording_transcripts(docs: DataFrame) -> DataFrame:
    """One row a recording: text, timed words (times moved by their chunk's start), first and last date."""
    from ..operators.keys import ordered_lists, ordered_text
    from ..operators.words import shifted

    chunks = flattened(docs).withColumn("_t", F.try_element_at("transcription", F.lit(1)))
    timed = chunks.withColumn("_text", F.col("_t.text")).withColumn("_raw", F.col("_t.word_timestamps")).withColumn("_words", shifted("_raw", F.col("start") / 1000))
    return timed.groupBy("audio_path").agg(
        ordered_text("pos", "_text").alias("inference_text"), ordered_lists("pos", "_words").alias("words"),
        F.min(F.array_min("dates")).alias("date_start"), F.max(F.array_max("dates")).alias("date_end"),
    )
