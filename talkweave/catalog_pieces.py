"""More queries on the test tables: files written and read again, projections and look-ups, times, vectors, words."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .catalog import SEGMENTS, event_segments, load, query
from .functions import alignment, cleaning, similarity, times, tokens
from .operators import chunking, keys, matching, runs, shards, slots, upsert, vectors, words
from .plans import publish
from .sources import readers, sinks
from .storage import shared_dir, stored

_WORDS = "list_filter(string_split_regex(text, '[\\t\\n\\x0b\\x0c\\r ]+'), lambda x: x <> '')"


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one."""
    return f"{shared_dir(spark)}/files/{uuid.uuid4().hex}"


def word_list() -> Column:
    return F.filter(F.split("text", r"[\t\n\x0B\f\r ]+"), lambda x: x != "")


# Files


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS party, CAST(c_nationkey AS VARCHAR) AS district FROM customer")
def csv_persons(spark: SparkSession, d: str) -> DataFrame:
    at, none = scratch(spark), F.lit(None).cast("string")
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Förnamn"), none.alias("Efternamn"), none.alias("Född"), none.alias("Kön"), F.col("c_nationkey").alias("Valkrets"), F.col("c_mktsegment").alias("Parti"), none.alias("Uppdragsroll"), none.alias("From"), none.alias("Tom"))
    c.write.csv(at, header=True)
    return readers.persons(spark, at).select(F.col("Id").alias("id"), F.col("Förnamn").alias("name"), F.col("Parti").alias("party"), F.col("Valkrets").alias("district"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """Turns as speeches: ten recordings, a second for each ten characters."""
    c = load(spark, d, "conversations")
    end = F.sum(F.length("text")).over(Window.partitionBy("conv_id").orderBy("turn"))
    start = F.col("conv_id") * 100_000.0 + (end - F.length("text")) / 10
    return c.select(F.format_string("rec%02d", F.col("conv_id") % 10).alias("audio_file"), "conv_id", "turn", "role", "text", start.alias("start_segment"), (F.length("text") / 10).alias("duration_segment"))


_TURNS = """turns AS (SELECT printf('rec%02d', conv_id % 10) AS audio_file, conv_id, turn, role, text,
  conv_id * 100000.0::DOUBLE + CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) - length(text) AS DOUBLE) / 10 AS start_segment, CAST(length(text) AS DOUBLE) / 10 AS duration_segment FROM conversations)"""


@query(f"WITH {_TURNS} SELECT audio_file, CAST(count(*) OVER f AS BIGINT) AS speeches, CAST(row_number() OVER (PARTITION BY audio_file ORDER BY start_segment) - 1 AS BIGINT) AS pos, conv_id, turn, text, start_segment FROM turns WINDOW f AS (PARTITION BY audio_file)")
def json_recordings(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document a recording, its speeches by time; written, read with a declared schema, and flattened."""
    at = scratch(spark)
    sinks.json(sinks.recording_documents(_turns(spark, d), "test"), at)
    schema = "audio_file STRING, metadata STRUCT<audio_file: STRING, number_of_speeches: BIGINT, duration: DOUBLE, data_source: STRING>, speeches ARRAY<STRUCT<conv_id: BIGINT, turn: BIGINT, role: STRING, text: STRING, start_segment: DOUBLE, duration_segment: DOUBLE>>"
    docs = spark.read.schema(schema).json(at)
    flat = readers.flattened(docs, "speeches")
    return flat.select("audio_file", F.col("number_of_speeches").alias("speeches"), F.col("pos").cast("long").alias("pos"), "conv_id", "turn", "text", "start_segment")


@query("""SELECT conv_id AS protocol_id, CAST(count(*) AS BIGINT) AS speeches, string_agg(role, ',' ORDER BY turn) AS roles, string_agg(DISTINCT CAST(DATE '2020-01-01' + CAST(turn % 3 AS INTEGER) AS VARCHAR), ',' ORDER BY CAST(DATE '2020-01-01' + CAST(turn % 3 AS INTEGER) AS VARCHAR)) AS dates FROM conversations GROUP BY conv_id""")
def json_protocols(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document a protocol, one file each, its speeches by number."""
    at = scratch(spark)
    c = load(spark, d, "conversations").select(F.col("conv_id").alias("protocol_id"), F.col("turn").alias("speech_number"), "role", F.array(F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("turn") % 3).cast("int")), "yyyy-MM-dd")).alias("dates"))
    sinks.json_each(sinks.protocol_documents(c), at, "protocol_id")
    schema = "protocol_id BIGINT, metadata STRUCT<number_of_speeches: BIGINT, dates: ARRAY<STRING>>, speeches ARRAY<STRUCT<speech_number: BIGINT, role: STRING>>"
    docs = readers.json_documents(spark, at, schema)
    return docs.select("protocol_id", F.col("metadata.number_of_speeches").alias("speeches"), F.array_join(F.transform("speeches", lambda x: x["role"]), ",").alias("roles"), F.array_join("metadata.dates", ",").alias("dates"))


@query("SELECT CAST(item_id AS VARCHAR) AS dok_id, text AS anforandetext, CASE WHEN item_id % 2 = 0 THEN 'someone' END AS talare FROM benchmark")
def bom_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries under a root key, one a file, with a byte-order mark; empty strings are null."""
    at = scratch(spark)
    entry = F.to_json(F.struct(F.struct(F.col("item_id").cast("string").alias("dok_id"), F.col("text").alias("anforandetext"), F.when(F.col("item_id") % 2 == 0, "someone").otherwise("").alias("talare")).alias("anforande")))
    load(spark, d, "benchmark").select(F.concat(F.lit("\ufeff"), entry).alias("value")).write.option("maxRecordsPerFile", 1).text(at)
    return readers.protocol_entries(spark, at).select("dok_id", "anforandetext", "talare")


@query(f"WITH {_TURNS} SELECT audio_file AS file, start_segment AS start, text, CAST(len({_WORDS}) AS BIGINT) AS n_words FROM turns")
def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    sinks.json(_turns(spark, d).select(F.col("audio_file").alias("file"), F.col("start_segment").alias("start"), (F.col("start_segment") + F.col("duration_segment")).alias("end"), "text"), at)
    return readers.segments(spark, at).select("file", "start", "text", F.size("words").cast("long").alias("n_words"))


@query("SELECT CAST(item_id AS VARCHAR) AS file, CAST(item_id AS DOUBLE) AS start, text FROM benchmark")
def segment_array(spark: SparkSession, d: str) -> DataFrame:
    """One file with one array of segments."""
    at = scratch(spark)
    item = F.struct(F.col("item_id").cast("string").alias("file"), F.col("item_id").cast("double").alias("start"), (F.col("item_id") + 1.0).alias("end"), "text")
    load(spark, d, "benchmark").agg(F.to_json(F.collect_list(item)).alias("value")).coalesce(1).write.text(at)
    return readers.segments(spark, at, array=True).select("file", "start", "text")


@query(f"""SELECT conv_id || '-' || turn AS utt, CAST(i * 400 AS BIGINT) AS start_ms, CAST(i * 400 + 350 AS BIGINT) AS end_ms, w[i + 1] AS word FROM (SELECT conv_id, turn, w, unnest(range(len(w))) AS i FROM (SELECT conv_id, turn, {_WORDS} AS w FROM conversations))""")
def ctm_words(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    w = load(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("utt"), F.posexplode(word_list()).alias("i", "word"))
    w.select(F.format_string("%s 1 %.2f 0.35 %s", "utt", F.col("i") * 0.4, "word").alias("value")).write.text(at)
    return readers.ctm(spark, at).select("utt", "start_ms", "end_ms", "word")


@query("""WITH f AS (SELECT 'rec/' || source || '.wav' AS file, item_id, (item_id * 2)::DOUBLE AS s, text FROM (SELECT item_id, replace(text, chr(10), ' ') AS text, 'b' || (item_id % 7) AS source FROM benchmark)),
n AS (SELECT *, dense_rank() OVER (ORDER BY file) AS r, row_number() OVER (PARTITION BY file ORDER BY s) AS k FROM f)
SELECT 'segments' AS kind, printf('seg%03d-%04d reco%03d %.2f %.2f', r, k, r, s, s + 1.5) AS line FROM n UNION ALL SELECT 'text', printf('seg%03d-%04d ', r, k) || text FROM n UNION ALL SELECT DISTINCT 'wav.scp', printf('reco%03d ', r) || file FROM n""")
def kaldi_folder(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    b = load(spark, d, "benchmark").select(F.concat(F.lit("rec/b"), (F.col("item_id") % 7).cast("string"), F.lit(".wav")).alias("file"), (F.col("item_id") * 2.0).alias("start"), (F.col("item_id") * 2.0 + 1.5).alias("end"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    sinks.kaldi(b, at)
    read = lambda n: spark.read.text(f"{at}/{n}").select(F.lit(n).alias("kind"), F.col("value").alias("line"))
    return read("segments").unionByName(read("text")).unionByName(read("wav.scp"))


@query("SELECT item_id AS utt, 'a/b c/' || item_id || '.wav' AS path FROM benchmark")
def wav_scp_lines(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    load(spark, d, "benchmark").select(F.format_string("%d  a/b c/%d.wav", "item_id", "item_id").alias("value")).write.text(at)
    return readers.wav_scp(spark, at).select(F.col("utt").cast("long").alias("utt"), "path")


@query(f"SELECT word, row_number() OVER (ORDER BY word) AS id FROM (SELECT DISTINCT unnest({_WORDS}) AS word FROM benchmark)")
def vocabulary_file(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    sinks.vocabulary(words.vocabulary(load(spark, d, "benchmark"), "text"), at)
    return sinks.read_vocabulary(spark, at)


@query("SELECT user_id % 5 AS shard, event_id, event_type FROM events")
def sharded_twice(spark: SparkSession, d: str) -> DataFrame:
    """Two shards, then all: those that are there stay as they are and none comes twice."""
    at = scratch(spark)
    e = load(spark, d, "events").select((F.col("user_id") % 5).alias("shard"), "event_id", "event_type")
    sinks.sharded(e.where("shard < 2"), at)
    sinks.sharded(e, at)
    return spark.read.schema(e.schema).parquet(at)


@query("SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) AS row_groups, count(*) AS n FROM customer")
def row_groups(spark: SparkSession, d: str) -> DataFrame:
    """A file in groups of 100 rows; the groups are counted in its footer."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = scratch(spark)
    sinks.parquet(load(spark, d, "customer").coalesce(1), at, block_rows=100)

    def run(parts):
        for part in parts:
            footers = [pq.ParquetFile(pa.BufferReader(bytes(c))).metadata for c in part["content"]]
            yield pd.DataFrame({"row_groups": [m.num_row_groups for m in footers], "n": [m.num_rows for m in footers]})

    return spark.read.format("binaryFile").load(at).select("content").mapInPandas(run, "row_groups long, n long")


@query("SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, CAST(list_max(embedding) AS DOUBLE) AS top, CAST(embedding[7] AS DOUBLE) AS seventh FROM embeddings")
def npy_round_trip(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark)
    e = load(spark, d, "embeddings").select((F.col("vec_id") % 10).alias("file"), F.col("vec_id").alias("speech_id"), F.array(F.lit(4), F.lit(16)).alias("shape"), F.col("embedding").alias("values"))
    sinks.npy_files(e, at.removeprefix("file:")).write.format("noop").mode("overwrite").save()
    got = readers.emissions(spark, at).where(F.size("shape") == 2)
    return got.select(cleaning.stem(F.col("path")).cast("long").alias("vec_id"), F.size("values").cast("long").alias("n"), F.array_max("values").cast("double").alias("top"), F.element_at("values", 7).cast("double").alias("seventh"))


@query("SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN NULL ELSE 16000 END AS rate, CASE WHEN vec_id % 10 = 0 THEN NULL ELSE CAST(len(embedding) AS BIGINT) END AS n, vec_id % 10 = 0 AS bad, CASE WHEN vec_id % 10 = 0 THEN NULL ELSE true END AS near FROM embeddings")
def wav_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Samples as WAV files and back, within the step of 16 bits; broken files give an error row each."""
    samples = F.transform("embedding", lambda x: F.greatest(F.least(x / 4, F.lit(1.0)), F.lit(-1.0)).cast("float"))
    e = load(spark, d, "embeddings").select("vec_id", samples.alias("samples"))
    files = e.select(F.col("vec_id").cast("string").alias("path"), F.when(F.col("vec_id") % 10 == 0, F.lit("junk").cast("binary")).otherwise(sinks.wav_bytes()("samples")).alias("content"))
    got = readers.decoded_audio(files).join(e.withColumn("path", F.col("vec_id").cast("string")), "path")
    near = F.forall(F.zip_with("audio", "samples", lambda a, b: F.abs(a - b) < 1e-4), lambda x: x)
    return got.select("vec_id", "rate", F.size("audio").cast("long").alias("n"), F.col("error").isNotNull().alias("bad"), near.alias("near")).withColumn("n", F.when(~F.col("bad"), F.col("n")))


@query("SELECT source AS dok_id, doc_id, 'audio/' || source || '/' || doc_id || '.mp3' AS target FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1")
def file_moves(spark: SparkSession, d: str) -> DataFrame:
    """Which file goes into which folder: the first of each key."""
    first = keys.first_per_key(load(spark, d, "documents"), ["source"], "doc_id")
    return first.select(F.col("source").alias("dok_id"), "doc_id", F.concat(F.lit("audio/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".mp3")).alias("target"))


@query("SELECT CAST(regexp_extract(url, '(\\d+)[^/]*$', 1) AS VARCHAR) AS id, url FROM pages WHERE length(html) > 2000 AND url NOT LIKE '%7'")
def large_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of a size, without those on a list (here the pages whose address ends with 7)."""
    p = load(spark, d, "pages").withColumn("size", F.length("html"))
    kept = keys.large_enough(p.where(~F.col("url").endswith("7")), "size", 2000, "url", ["nothing"])
    return kept.select(F.regexp_extract("url", r"(\d+)[^/]*$", 1).alias("id"), "url")


# Projections and look-ups


@query("SELECT c_custkey, unnest([c_name, c_mktsegment]) AS item FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 2 = 1")
def exploded_lists(spark: SparkSession, d: str) -> DataFrame:
    """Null and empty lists keep a null row."""
    listed = F.when(F.col("c_custkey") % 2 == 0, F.array("c_name", "c_mktsegment")).when(F.col("c_custkey") % 4 == 1, F.array().cast("array<string>"))
    return load(spark, d, "customer").select("c_custkey", F.explode_outer(listed).alias("item"))


@query("SELECT event_id, CAST(CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n, CASE WHEN event_id % 5 = 0 THEN NULL ELSE json_extract_string(props, '$.page') END AS first_page FROM events")
def scalar_or_list(spark: SparkSession, d: str) -> DataFrame:
    """One object, or a list of them, as a list; other text is null."""
    e = load(spark, d, "events")
    json = F.when(F.col("event_id") % 5 == 0, "none").when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit(" ["), "props", F.lit(","), "props", F.lit("]")))
    listed = e.withColumn("json", json).withColumn("l", readers.coerced_list("json", "struct<page: string, ref: string, k: string>"))
    n = F.when(F.col("l").isNotNull(), F.size("l")).cast("long")
    return listed.select("event_id", n.alias("n"), F.try_element_at("l", F.lit(1))["page"].alias("first_page"))


@query("""SELECT conv_id, arg_min(text, turn) AS first_text, arg_max(role, turn) AS last_role, CASE WHEN count(*) >= 3 THEN max(text) FILTER (WHERE k = 3) END AS third_text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) GROUP BY conv_id""")
def picked_fields(spark: SparkSession, d: str) -> DataFrame:
    """Fields of list elements by place, beside the other columns; null where the list is too short."""
    c = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("r"))
    at = lambda i: F.try_element_at("r", F.lit(i))
    return c.select("conv_id", at(1)["text"].alias("first_text"), at(-1)["role"].alias("last_role"), at(3)["text"].alias("third_text"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'BRASS|STEEL') THEN 'METAL' WHEN contains(p_type, 'COPPER') THEN 'RED' ELSE p_brand END AS p_brand, CASE WHEN contains(p_type, 'SMALL') THEN 1 ELSE p_size END AS p_size FROM part")
def corrected_values(spark: SparkSession, d: str) -> DataFrame:
    rules = [("COPPER", "p_brand", "RED"), ("BRASS|STEEL", "p_brand", "METAL"), ("SMALL", "p_size", 1)]
    return keys.corrected(load(spark, d, "part"), "p_type", rules).select("p_partkey", "p_brand", "p_size")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def unique_columns(spark: SparkSession, d: str) -> DataFrame:
    """The first of equally named columns after a join."""
    n, r = load(spark, d, "nation"), load(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    both = n.join(r, n.n_regionkey == r.n_regionkey)
    return keys.unique_columns(both).select("n_nationkey", "n_name", "r_name")


@query("SELECT doc_id, split_part(lang || ', ' || source, ', ', 1) AS first_item, nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, '') AS known FROM documents")
def first_listed(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", cleaning.first_of_list(F.concat("lang", F.lit(", "), "source")).alias("first_item"), cleaning.null_if_empty(F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))).alias("known"))


def _chunked(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as documents of chunks; users' turns are silent, assistants' are transcribed by b with word times."""
    time = F.array(F.struct(F.lit("w").alias("word"), F.lit(0.0).alias("start_time"), F.lit(0.5).alias("end_time")))
    result = lambda m, t: F.struct(F.col("text"), F.lit(m).alias("model"), t.alias("word_timestamps"))
    none = F.lit(None).cast("array<struct<word: string, start_time: double, end_time: double>>")
    said = F.when(F.col("role") == "assistant", F.array(result("a", none), result("b", time))).when(F.col("role") == "user", F.array(result("a", none)))
    chunk = F.struct("turn", F.when(F.col("role") == "user", "").otherwise(F.col("text")).alias("text"), said.alias("transcription"))
    c = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(chunk)).alias("chunks"))
    return c.withColumn("chunks", F.transform("chunks", lambda x: F.struct(x["text"].alias("text"), x["transcription"].alias("transcription"))))


@query("""SELECT conv_id, count(*) FILTER (WHERE role <> 'user' AND text <> '') AS spoken, CASE WHEN count(*) FILTER (WHERE role <> 'user' AND text <> '') = 0 THEN count(*) ELSE count(*) FILTER (WHERE role <> 'user' AND text <> '') END AS spoken_or_all,
  count(*) FILTER (WHERE role = 'system') AS left_to_do, arg_min(role, turn) IN ('assistant', 'user') AS transcribed, arg_min(role, turn) = 'assistant' AS by_model, arg_min(role, turn) = 'assistant' AS with_times FROM conversations GROUP BY conv_id""")
def chunk_states(spark: SparkSession, d: str) -> DataFrame:
    c = _chunked(spark, d).withColumn("s", upsert.states("chunks", "b"))
    todo = F.size(F.filter("chunks", lambda x: x["transcription"].isNull())).cast("long")
    return c.select("conv_id", upsert.spoken_chunks("chunks").cast("long").alias("spoken"), upsert.spoken_chunks("chunks", True).cast("long").alias("spoken_or_all"), todo.alias("left_to_do"), "s.transcribed", "s.by_model", "s.with_times")


@query("SELECT doc_id, source FROM documents WHERE quality IS NULL UNION ALL SELECT doc_id, 'aligned' FROM documents WHERE quality IS NOT NULL".replace("documents WHERE", "(SELECT d.doc_id, source, quality FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE"))
def aligned_state(spark: SparkSession, d: str) -> DataFrame:
    """Whether a nested result is there."""
    both = load(spark, d, "documents").join(load(spark, d, "labels").select("doc_id", F.struct("quality").alias("subs")), "doc_id", "left")
    return both.select("doc_id", F.when(F.col("subs").isNotNull(), "aligned").otherwise(F.col("source")).alias("source"))


@query("""SELECT page_id, item_id FROM pages LEFT JOIN (SELECT item_id, 'p' || (item_id % 20) AS file FROM benchmark QUALIFY row_number() OVER (PARTITION BY item_id % 20 ORDER BY item_id) = 1) ON file = 'p' || (page_id % 40)""")
def first_hit_lookup(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "pages").select("page_id", F.concat(F.lit("data/x/p"), (F.col("page_id") % 40).cast("string")).alias("path"))
    b = load(spark, d, "benchmark").select("item_id", F.concat(F.lit("p"), (F.col("item_id") % 20).cast("string")).alias("file"))
    return keys.lookup_first(p, "path", b, "file", "item_id").select("page_id", "item_id")


@query("SELECT c_custkey, list_str FROM customer LEFT JOIN (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS list_str FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def mapped_lists(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.struct("o_orderdate", "o_orderkey").alias("at"), F.col("o_orderkey").cast("string").alias("k"))
    got = keys.mapped_lists(load(spark, d, "customer").select("c_custkey"), "c_custkey", o, "at", "k", "l")
    return got.select("c_custkey", F.array_join("l", ",").alias("list_str"))


@query(f"SELECT conv_id, string_agg(w, ' ' ORDER BY turn, i) AS all_words FROM (SELECT conv_id, turn, unnest(range(len(l))) AS i, unnest(l) AS w FROM (SELECT conv_id, turn, {_WORDS} AS l FROM conversations)) GROUP BY conv_id")
def joined_lists(spark: SparkSession, d: str) -> DataFrame:
    """Lists put one after the other in order."""
    c = load(spark, d, "conversations").select("conv_id", "turn", word_list().alias("w"))
    return c.groupBy("conv_id").agg(F.array_join(keys.ordered_lists("turn", "w"), " ").alias("all_words"))


@query("""WITH top AS (SELECT max(o_orderkey % 100) + 1 AS n FROM orders WHERE o_orderstatus = 'F') SELECT DISTINCT CAST(s_suppkey AS BIGINT) AS s_suppkey, 'train_' || lpad(CAST(s_suppkey % 50 + n AS VARCHAR), 4, '0') || '.parquet' AS new_file FROM supplier, top""")
def renumbered_shards(spark: SparkSession, d: str) -> DataFrame:
    """Numbers in file names moved on behind the highest existing one."""
    name = lambda c: F.concat(F.lit("train_"), F.lpad(c.cast("string"), 4, "0"), F.lit(".parquet"))
    new = load(spark, d, "supplier").select("s_suppkey", name(F.col("s_suppkey") % 50).alias("file"))
    old = load(spark, d, "orders").where("o_orderstatus = 'F'").select(name(F.col("o_orderkey") % 100).alias("have"))
    return shards.renumbered(new, "file", old, "have").select("s_suppkey", "new_file").distinct()


@query("SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS place FROM events")
def original_order(spark: SparkSession, d: str) -> DataFrame:
    """Rows numbered, sorted by something else, and back in their first order."""
    e = shards.numbered(load(spark, d, "events"), "event_id", "place")
    return e.orderBy(F.desc("value"), "event_id").orderBy("place").select("event_id", "value", "place")


@query("""SELECT c_nationkey AS k, 'both' AS side FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT c_nationkey, 'customers' FROM (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    both = c.select(F.col("c_nationkey").alias("k")).intersect(s.select("s_nationkey")).withColumn("side", F.lit("both"))
    rest = c.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).subtract(s.where("s_acctbal > 5000").select("s_nationkey")).withColumn("side", F.lit("customers"))
    return both.unionByName(rest)


@query(f"""WITH v AS (SELECT word, row_number() OVER (ORDER BY word) AS id FROM (SELECT DISTINCT unnest({_WORDS}) AS word FROM documents))
SELECT 'tokens' AS name, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM (SELECT id FROM v WHERE regexp_matches(word, '[0-9%$£]') UNION SELECT unnest([1, 2, 3]))""")
def suppressed_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Ids of words with digits or such signs, and some fixed ones: a union of sets."""
    v = words.vocabulary(load(spark, d, "documents"), "text")
    numeric = v.where(F.col("word").rlike("[0-9%$£]")).agg(F.collect_set("id").alias("a"))
    union = F.array_sort(F.array_union("a", F.array(*(F.lit(i).cast("long") for i in (1, 2, 3)))))
    return numeric.select(F.lit("tokens").alias("name"), F.array_join(F.transform(union, lambda x: x.cast("string")), ",").alias("ids"))


# Texts


@query("""SELECT n_nationkey, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM nation""")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    """Titles and parentheses out, title case."""
    n = load(spark, d, "nation")
    return n.select("n_nationkey", cleaning.clean_name(F.concat(F.lit("Fru "), F.upper("n_name"), F.lit(" (S)"))).alias("name"))


@query(f"SELECT doc_id, CAST(len({_WORDS}) AS BIGINT) AS n_words, CAST(len(list_filter({_WORDS}, lambda w: NOT regexp_matches(w, '[\\p{{L}}\\p{{N}}]'))) AS BIGINT) AS signs FROM documents")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", cleaning.n_words(F.col("text")).cast("long").alias("n_words"), F.size(cleaning.only_signs(F.col("text"))).cast("long").alias("signs"))


@query(f"SELECT lang, CAST(sum(len({_WORDS})) AS BIGINT) AS n_words, count(*) AS n FROM documents GROUP BY lang")
def total_words(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").groupBy("lang").agg(F.sum(cleaning.n_words(F.col("text"))).cast("long").alias("n_words"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT item_id, array_to_string(regexp_extract_all(text, '(?s)(\\p{{L}}+|[0-9]+|\\.+|.)', 1), chr(1)) AS parts FROM benchmark")
def divided_tokens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "benchmark").select("item_id", F.array_join(tokens.divided(F.col("text")), "\x01").alias("parts"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '(?:^|[ \\n])(\\p{Lu}\\p{Ll}?\\.)', 1), ' ') AS found FROM documents")
def abbreviations_found(spark: SparkSession, d: str) -> DataFrame:
    """Short capitalised words with a dot, as they might be abbreviations."""
    return load(spark, d, "documents").select("doc_id", F.array_join(F.regexp_extract_all("text", F.lit(r"(?:^|[ \n])(\p{Lu}\p{Ll}?\.)"), 1), " ").alias("found"))


@query(f"""WITH v AS (SELECT word, row_number() OVER (ORDER BY word) AS id FROM (SELECT DISTINCT unnest({_WORDS}) AS word FROM benchmark)), w AS (SELECT conv_id, turn, unnest(range(len(l))) AS i, unnest(l) AS word FROM (SELECT conv_id, turn, {_WORDS} AS l FROM conversations))
SELECT conv_id, string_agg(word, ' ' ORDER BY turn, i) AS known FROM w JOIN v USING (word) GROUP BY conv_id""")
def decoded_ids(spark: SparkSession, d: str) -> DataFrame:
    """Words to ids of another text's vocabulary and back: what it lacks is gone."""
    v = words.vocabulary(load(spark, d, "benchmark"), "text")
    coded = words.encoded_words(load(spark, d, "conversations").withColumn("k", F.struct("conv_id", "turn")), "k", "text", v)
    return words.decoded_words(coded.select("k.conv_id", F.struct("k.turn", "word_index").alias("at"), "id"), "conv_id", "at", "id", v).withColumnRenamed("text", "known")


# Times and vectors


@query("""SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity * 16) AS BIGINT) AS frames, round(l_linenumber * 320 / 16000.0, 2) AS first_s, round((l_linenumber + 5) * 320 / 16000.0, 2) AS last_s, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber * (480000.0 / (1499 * (l_linenumber <> 7)::INT)) / 16000 + l_quantity END AS logit_s FROM lineitem""")
def logit_times(spark: SparkSession, d: str) -> DataFrame:
    """Frames, word offsets in seconds, and times of logits; without logits there is no time."""
    l = load(spark, d, "lineitem")  # noqa: E741
    word = F.array(F.struct(F.lit("w").alias("word"), F.col("l_linenumber").alias("start_offset"), (F.col("l_linenumber") + 5).alias("end_offset")))
    w = times.offset_seconds(word)[0]
    logits = F.when(F.col("l_linenumber") == 7, 0).otherwise(1499)
    return l.select("l_orderkey", "l_linenumber", times.frames(F.col("l_quantity")).alias("frames"), w["start_time"].alias("first_s"), w["end_time"].alias("last_s"), times.logit_time(F.col("l_linenumber"), F.lit(480_000.0), logits, F.col("l_quantity")).alias("logit_s"))


@query("SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[11] AS DOUBLE) AS b, CAST(embedding[31] AS DOUBLE) AS c, '10,20,34' AS sizes FROM embeddings")
def unflattened_vectors(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "embeddings").withColumn("n", F.array(F.lit(10), F.lit(20), F.lit(34)))
    parts = e.withColumn("p", vectors.unflattened("embedding", "n"))
    return parts.select("vec_id", *(F.col("p")[i][0].cast("double").alias(x) for i, x in enumerate("abc")), F.array_join(F.transform("p", lambda x: F.size(x).cast("string")), ",").alias("sizes"))


@query("""WITH p AS (SELECT vec_id, embedding, list_transform(embedding[1:4], lambda x: exp(CAST(x AS DOUBLE) - CAST(list_max(embedding[1:4]) AS DOUBLE))) AS e FROM embeddings)
SELECT vec_id, round(e[1] / list_sum(e), 9) AS sv, round(e[4] / list_sum(e), 9) AS fi, ['sv', 'no', 'da', 'fi'][list_position(e, list_max(e))] AS best FROM p""")
def language_shares(spark: SparkSession, d: str) -> DataFrame:
    """Scores of four languages as probabilities, and the best one."""
    e = load(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double")).alias("s"))
    m = e.withColumn("p", slots.language_probabilities("s", ["sv", "no", "da", "fi"]))
    best = F.element_at(F.array(*(F.lit(x) for x in ("sv", "no", "da", "fi"))), F.array_position("s", F.array_max("s")).cast("int"))
    return m.select("vec_id", F.round(F.col("p")["sv"], 9).alias("sv"), F.round(F.col("p")["fi"], 9).alias("fi"), best.alias("best"))


@query("""SELECT vec_id, CAST(i AS BIGINT) AS piece, CAST(least(10, 64 - i * 10) AS BIGINT) AS n, CAST(embedding[i * 10 + 1] AS DOUBLE) AS head, CAST(embedding[i * 4 + 1] AS DOUBLE) AS cut_head, 4::BIGINT AS cut_n FROM embeddings, (SELECT unnest(range(7)) AS i)""")
def audio_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Samples in pieces of ten, and intervals of 4 ms at 1,000 samples a second."""
    p = load(spark, d, "embeddings").select("vec_id", "embedding", F.posexplode(times.pieces(F.col("embedding"), 10)).alias("piece", "x"))
    part = vectors.cut_audio("embedding", F.col("piece") * 4, F.col("piece") * 4 + 4, 1000)
    return p.select("vec_id", F.col("piece").cast("long").alias("piece"), F.size("x").cast("long").alias("n"), F.col("x")[0].cast("double").alias("head"), part[0].cast("double").alias("cut_head"), F.size(part).cast("long").alias("cut_n"))


@query("""SELECT vec_id, CAST(k AS BIGINT) AS run, CAST((e - s) * 4 AS BIGINT) AS n, CAST(embedding[s * 4 + 1] AS DOUBLE) AS head, CAST(embedding[e * 4] AS DOUBLE) AS last FROM embeddings, (VALUES (0, 0, 3), (1, 5, 6), (2, 10, 16)) t(k, s, e)""")
def emission_runs(spark: SparkSession, d: str) -> DataFrame:
    """Scores of 16 frames, four a frame, cut by runs of speech."""
    runs_ = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 3), (5, 6), (10, 16))))
    e = load(spark, d, "embeddings").withColumn("runs", runs_).select("vec_id", F.posexplode(vectors.frames_of("embedding", 4, "runs")).alias("run", "x"))
    return e.select("vec_id", F.col("run").cast("long").alias("run"), F.size("x").cast("long").alias("n"), F.col("x")[0].cast("double").alias("head"), F.element_at("x", -1).cast("double").alias("last"))


def _timed(spark: SparkSession, d: str) -> DataFrame:
    """Words of each turn at ten a second, moved by the turn's number in seconds."""
    w = F.transform(word_list(), lambda x, i: F.struct(x.alias("word"), (i / 10).alias("start_time"), (i / 10 + 0.05).alias("end_time")))
    return load(spark, d, "conversations").select("conv_id", "turn", w.alias("w")).withColumn("w", words.shifted("w", F.col("turn").cast("double")))


@query(f"""WITH t AS (SELECT conv_id, turn, len({_WORDS}) AS n, CASE WHEN turn % 4 = 3 THEN NULL ELSE 2 END AS a, 6 AS b FROM conversations)
SELECT conv_id, turn, CASE WHEN a IS NOT NULL AND n > 2 THEN round(2 / 10.0::DOUBLE + turn, 6) END AS start_time, CASE WHEN n > 0 THEN round((least(b, n) - 1) / 10.0::DOUBLE + 0.05 + turn, 6) END AS end_time FROM t""")
def word_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Times of the words 2 to 6; without a first word no start, beyond the end the last word's end."""
    t = _timed(spark, d).withColumns({"a": F.when(F.col("turn") % 4 != 3, 2), "b": F.lit(6)}).withColumn("t", words.time_bounds("w", "a", "b"))
    return t.select("conv_id", "turn", F.round("t.start_time", 6).alias("start_time"), F.round("t.end_time", 6).alias("end_time"))


@query(f"""WITH RECURSIVE {SEGMENTS}, o AS (SELECT recording, start_ms AS s, end_ms AS e, label, row_number() OVER (PARTITION BY recording ORDER BY start_ms, end_ms, label) AS k FROM segments), f AS (
  SELECT recording, k, s AS begin, e, 0 AS part FROM o WHERE k = 1
  UNION ALL SELECT o.recording, o.k, CASE WHEN f.e - f.begin >= 7200000 THEN o.s ELSE f.begin END, o.e, CASE WHEN f.e - f.begin >= 7200000 THEN f.part + 1 ELSE f.part END FROM f JOIN o ON o.recording = f.recording AND o.k = f.k + 1)
SELECT recording, CAST(part AS BIGINT) AS part, min(s) AS start_ms, max(o.e) AS end_ms, string_agg(label, ' ' ORDER BY k) AS text FROM f JOIN o USING (recording, k) GROUP BY recording, part""")
def long_parts(spark: SparkSession, d: str) -> DataFrame:
    """Words in order, in parts of a length at least (here two hours)."""
    return chunking.concatenated(event_segments(spark, d).select("recording", "start_ms", "end_ms", F.col("label").alias("word")), "recording", 7_200_000)


@query("""WITH c AS (SELECT user_id, event_type, count(*)::DOUBLE AS n, max(value) AS v FROM events GROUP BY ALL) SELECT user_id, event_type, CASE WHEN v > 300 THEN v ELSE n END AS p FROM c""")
def language_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Two maps, the new one's values where both have a key."""
    c = load(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("value").alias("v"))
    pairs = lambda x, keep: F.map_from_entries(F.filter(F.collect_list(F.when(keep, F.struct("event_type", x))), lambda e: e.isNotNull()))
    m = c.groupBy("user_id").agg(pairs("n", F.lit(True)).alias("old"), pairs("v", F.col("v") > 300).alias("new"))
    return m.select("user_id", F.explode(upsert.merged_map("old", "new")).alias("event_type", "p"))


@query(f"""WITH t AS (SELECT conv_id, turn, len({_WORDS}) AS n FROM conversations WHERE turn % 5 <> 4) SELECT conv_id, turn, CAST(n AS BIGINT) AS n, CAST(max(n) OVER (PARTITION BY conv_id) AS BIGINT) AS filled, CAST(max(n) OVER (PARTITION BY conv_id) - n AS BIGINT) AS zeros FROM t""")
def collated_batches(spark: SparkSession, d: str) -> DataFrame:
    """Rows without values go, the others are filled up to the longest of their batch."""
    values = F.when(F.col("turn") % 5 != 4, F.transform(word_list(), lambda x: F.lit(1.0).cast("float")))
    b = vectors.collated(load(spark, d, "conversations").select("conv_id", "turn", values.alias("v")), "conv_id", "v")
    return b.select("conv_id", "turn", F.col("n").cast("long").alias("n"), F.size("v").cast("long").alias("filled"), F.size(F.filter("v", lambda x: x == 0)).cast("long").alias("zeros"))


@query("SELECT event_id, event_type FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS k FROM events) WHERE k % 8 = 3")
def worker_share(spark: SparkSession, d: str) -> DataFrame:
    """Every eighth row from the fourth on, of all columns."""
    return vectors.share(load(spark, d, "events"), 8, 3, "event_id").select("event_id", "event_type")


@query("SELECT user_id, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def regrouped_batches(spark: SparkSession, d: str) -> DataFrame:
    """Keys that cross the borders of batches come whole."""

    def whole(g: pd.DataFrame) -> pd.DataFrame:
        assert g["event_id"].is_monotonic_increasing
        return pd.DataFrame({"user_id": [g["user_id"].iloc[0]], "n": [len(g)], "first_id": [g["event_id"].iloc[0]], "last_id": [g["event_id"].iloc[-1]], "total": [round(g["value"].sum(), 4)]})

    return slots.regrouped(load(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "event_id", whole, "user_id long, n long, first_id long, last_id long, total double")


@query("""WITH f AS (SELECT user_id, event_id, coalesce(value > 100, false) AS b, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events), g AS (SELECT *, k - row_number() OVER (PARTITION BY user_id, b ORDER BY event_id) AS island FROM f WHERE b)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM g GROUP BY user_id, island""")
def true_regions(spark: SparkSession, d: str) -> DataFrame:
    return runs.true_regions(load(spark, d, "events").withColumn("b", F.col("value") > 100), ["user_id"], "b", "event_id")


# Alignment, matching, scores


_LETTERS = {c: i for i, c in enumerate("-|abcdefghijklmnopqrstuvwxyz")}


def _emitted(df: DataFrame, key: str) -> DataFrame:
    """(key, text, values): frame scores that a model of letters might give: each letter of a text, and the gap between words,
    for one frame, and a blank after each. Stands in for an acoustic model."""
    width = len(_LETTERS)

    def run(parts):
        import numpy as np

        for part in parts:
            out = []
            for t in part["text"]:
                path = [x for c in t.replace(" ", "|") for x in (_LETTERS[c], 0)]
                lp = np.full((len(path), width), np.log(0.08 / (width - 2)), "float32")
                lp[:, 0] = np.log(0.02)
                lp[np.arange(len(path)), path] = np.log(0.9)
                out.append(lp.ravel())
            yield pd.DataFrame({key: part[key], "text": part["text"], "values": out})

    clean = F.trim(F.regexp_replace(F.lower("text"), "[^a-z]+", " "))
    return df.select(key, clean.alias("text")).where("text <> ''").mapInPandas(run, f"{key} long, text string, values array<float>")


_SPOKEN = "SELECT item_id, trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) AS t FROM benchmark"


@query(f"""WITH w AS (SELECT item_id, unnest(range(len(l))) AS i, l FROM (SELECT item_id, string_split(t, ' ') AS l FROM ({_SPOKEN}) WHERE t <> ''))
SELECT item_id, CAST(i AS BIGINT) AS word_index, l[i + 1] AS word, round(item_id + 0.02 * 2 * coalesce(list_sum(list_transform(l[1:i], lambda x: length(x) + 1)), 0), 6) AS start_time,
  round(item_id + 0.02 * (2 * (coalesce(list_sum(list_transform(l[1:i], lambda x: length(x) + 1)), 0) + length(l[i + 1])) - 1), 6) AS end_time FROM w""")
def forced_words(spark: SparkSession, d: str) -> DataFrame:
    """Forced alignment of benchmark passages over the scores of a stand-in for a model: times of every word."""
    e = _emitted(load(spark, d, "benchmark"), "item_id")
    found = e.select("item_id", F.posexplode(alignment.word_times_udf(_LETTERS, 0.02)("values", "text", F.col("item_id").cast("double"))).alias("word_index", "w"))
    return found.select("item_id", F.col("word_index").cast("long").alias("word_index"), "w.word", F.round("w.start_time", 6).alias("start_time"), F.round("w.end_time", 6).alias("end_time"))


@query(f"""WITH w AS (SELECT item_id, string_split(t, ' ') AS l FROM ({_SPOKEN}) WHERE t <> ''), u AS (SELECT item_id, l, unnest(range(CAST(ceil(len(l) / 5.0) AS BIGINT))) AS k FROM w), p AS (SELECT item_id, k, 2 * coalesce(list_sum(list_transform(l[1:k * 5], lambda x: length(x) + 1)), 0) AS a, array_to_string(l[k * 5 + 1:k * 5 + 5], ' ') AS t FROM u)
SELECT item_id, CAST(k AS BIGINT) AS utterance, t AS text, round(0.02 * a, 6) AS start_time, round(0.02 * (a + 2 * length(t) - 1), 6) AS end_time FROM p""")
def segmented_utterances(spark: SparkSession, d: str) -> DataFrame:
    """CTC segmentation: utterances of five words in the scores of the whole passage."""
    e = _emitted(load(spark, d, "benchmark"), "item_id").withColumn("l", F.split("text", " "))
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / 5).cast("int")), lambda k: F.array_join(F.slice("l", k * 5 + 1, F.lit(5)), " "))
    found = e.withColumn("u", groups).withColumn("s", alignment.segments_udf(_LETTERS, 0.02)("values", "u"))
    flat = found.select("item_id", F.posexplode(F.arrays_zip("u", "s")).alias("utterance", "x"))
    return flat.select("item_id", F.col("utterance").cast("long").alias("utterance"), F.col("x.u").alias("text"), F.round("x.s.start_time", 6).alias("start_time"), F.round("x.s.end_time", 6).alias("end_time"))


@query("SELECT vec_id, 80::BIGINT AS bands, CAST(1600 // 160 AS BIGINT) AS frames, true AS scaled FROM embeddings WHERE vec_id < 40")
def log_mel_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of tones, one for each of forty vectors: bands, frames, and the range of two (eight decades of power by four)."""
    tone = F.transform(F.sequence(F.lit(0), F.lit(1599)), lambda i: F.sin(i * (F.col("vec_id") + 1) / 50).cast("float"))
    m = load(spark, d, "embeddings").where("vec_id < 40").select("vec_id", alignment.log_mel_udf()(tone).alias("m"))
    return m.select("vec_id", F.lit(80).cast("long").alias("bands"), (F.size("m") / 80).cast("long").alias("frames"), (F.array_max("m") - F.array_min("m") <= 2.0001).alias("scaled"))


@query()
def sentence_spans(spark: SparkSession, d: str) -> DataFrame:
    s = load(spark, d, "documents").select("doc_id", F.explode(alignment.sentences_udf(("bl.a.", "t.ex."))("text")).alias("s"))
    return s.select("doc_id", "s.start", "s.end", "s.text")


@query()
def ngram_located(spark: SparkSession, d: str) -> DataFrame:
    """Each turn in the whole of its conversation by n-grams."""
    c = load(spark, d, "conversations")
    whole = c.groupBy("conv_id").agg(keys.ordered_text("turn", "text").alias("whole"))
    found = c.join(whole, "conv_id").select("conv_id", "turn", similarity.locate_udf(finder=similarity.ngram_locate)("text", "whole").alias("m"))
    return found.select("conv_id", "turn", "m.word_start", "m.word_end", F.round("m.score", 6).alias("score"))


@query()
def matched_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Turns as recognised segments, in order, against the whole text of their conversation."""
    c = load(spark, d, "conversations")
    s = c.select("conv_id", F.lit("f").alias("file"), F.col("turn").cast("double").alias("start"), (F.col("turn") + 1.0).alias("end"), "text")
    whole = c.groupBy("conv_id").agg(keys.ordered_text("turn", "text").alias("text"))
    return matching.matched(s, whole, "conv_id").select("conv_id", "start", "first", "last", F.round("ratio", 6).alias("ratio"))


@query("""SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 1.0::DOUBLE END AS w2v_ratio, CASE WHEN role IN ('assistant', 'user') AND len(list_filter(string_split_regex(text, '[ \\n]+'), lambda x: x <> '')) > 0 THEN 0.0::DOUBLE END AS whisper_wer,
  CASE WHEN role IN ('assistant', 'user') THEN 0.0::DOUBLE END AS whisper_cer_head FROM conversations WHERE text <> ''""")
def two_model_scores(spark: SparkSession, d: str) -> DataFrame:
    """The same scores for two models' texts: both say what was written, one only for assistants."""
    result = lambda m: F.struct("text", F.lit(m).alias("model"))
    said = F.when(F.col("role") == "assistant", F.array(result("a"), result("b"))).when(F.col("role") == "user", F.array(result("a")))
    c = load(spark, d, "conversations").where("text <> ''").withColumn("transcription", said)
    s = publish.scored_models(c, {"whisper": "a", "w2v": "b"})
    return s.select("conv_id", "turn", (F.col("w2v_first") / 100).alias("w2v_ratio"), F.col("whisper_wer").alias("whisper_wer"), F.col("whisper_cer_head").alias("whisper_cer_head"))


@query()
def timed_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Spans of the normalised text with the times of their words, by key."""
    from .functions import normalise

    b = load(spark, d, "benchmark")
    spans = b.select("item_id", F.explode(normalise.spans_udf("sv")("text")).alias("s")).select("item_id", "s.index", "s.replacement", "s.original_start", "s.original_end")
    w = spans.where("trim(replacement) <> ''").select("item_id", F.col("index").alias("normalized_word_index"), F.lit(0).alias("position"), (F.col("index") * 0.1).alias("start_time"), (F.col("index") * 0.1 + 0.05).alias("end_time"))
    return chunking.timed_spans(spans, stored(w), "item_id")
