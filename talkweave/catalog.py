"""The library's queries on the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import cleaning, normalise, numbers_sv, similarity, times, tokens
from .operators import chunking, intervals, keys, matching, runs, shards, upsert, vectors, voice, words
from .plans import refine, report
from .storage import stored
from .streaming import sessions as stream_sessions

FLAGSHIP = "refine_speeches"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
DAY = 86_400_000


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_segments(spark: SparkSession, d: str) -> DataFrame:
    """Events as labelled segments of their user's recording; the value is their length in seconds."""
    start = times.epoch_ms("ts")
    return load(spark, d, "events").select(F.col("user_id").alias("recording"), F.col("event_type").alias("label"), F.col("event_id").alias("pos"), start.alias("start_ms"), (start + F.round(F.col("value") * 1000).cast("long")).alias("end_ms"), "value")


def day_speeches(segments: DataFrame) -> DataFrame:
    """What a user does within a day, as a speech."""
    return segments.groupBy("recording", F.floor(F.col("start_ms") / DAY).alias("speech_id")).agg(F.min("start_ms").alias("b_start_ms"), F.max("end_ms").alias("b_end_ms"))


SEGMENTS = """segments AS (
  SELECT user_id AS recording, event_type AS label, event_id AS pos, epoch_us(ts) // 1000 AS start_ms,
    epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS end_ms, value FROM events
), speeches AS (
  SELECT recording, CAST(start_ms // 86400000 AS BIGINT) AS speech_id, min(start_ms) AS b_start_ms, max(end_ms) AS b_end_ms FROM segments GROUP BY ALL
)"""
RUNS = SEGMENTS + """, marked AS (
  SELECT *, CASE WHEN label IS DISTINCT FROM lag(label) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS a,
    CASE WHEN label IS DISTINCT FROM lead(label) OVER w OR lead(1) OVER w IS NULL THEN 1 ELSE 0 END AS b
  FROM segments WHERE end_ms - start_ms >= 600 WINDOW w AS (PARTITION BY recording ORDER BY pos)
), numbered AS (
  SELECT *, CAST(sum(a) OVER (PARTITION BY recording ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_id FROM marked
), runs AS (
  SELECT recording, run_id, min(label) AS label, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM numbered WHERE a = 1 OR b = 1 GROUP BY recording, run_id
)"""  # fmt: skip


@query(f"WITH {RUNS} SELECT * FROM runs")
def runs_by_label(spark: SparkSession, d: str) -> DataFrame:
    return runs.label_runs(event_segments(spark, d).where("end_ms - start_ms >= 600"), ["recording"], "label", ["pos"])


@query(f"WITH {RUNS} SELECT recording, pos, label FROM marked WHERE a = 1 OR b = 1")
def run_ends_only(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_ends(event_segments(spark, d).where("end_ms - start_ms >= 600"), ["recording"], "label", "pos").select("recording", "pos", "label")


@query(f"""WITH {RUNS}, pairs AS (
  SELECT r.*, s.speech_id, b_start_ms, b_end_ms, least(end_ms, b_end_ms) - greatest(start_ms, b_start_ms) AS overlap_ms, b_end_ms - b_start_ms AS duration_text
  FROM runs r JOIN speeches s USING (recording) WHERE least(end_ms, b_end_ms) - greatest(start_ms, b_start_ms) > 0
), ratios AS (
  SELECT *, overlap_ms / nullif(duration_text, 0) AS overlap_ratio, sum(end_ms - start_ms) OVER (PARTITION BY recording, speech_id, label) / sum(overlap_ms) OVER (PARTITION BY recording, speech_id) AS q,
    count(*) OVER (PARTITION BY recording, speech_id) AS nr_speech_segments FROM pairs
), scored AS (
  SELECT * FROM (SELECT *, CASE WHEN q > 1 THEN 1 / (q * q) ELSE q END AS speaker_ratio FROM ratios WHERE overlap_ratio > 1e-7) WHERE speaker_ratio > 0.25
), edges AS (
  SELECT *, label IS DISTINCT FROM lag(label) OVER w OR row_number() OVER w = 1 OR label IS DISTINCT FROM lead(label) OVER w OR lead(1) OVER w IS NULL AS edge
  FROM scored WINDOW w AS (PARTITION BY recording, speech_id ORDER BY start_ms, end_ms)
), wide AS (
  SELECT *, min(start_ms) OVER p AS start_segment_ms, max(end_ms) OVER p AS end_segment_ms, (overlap_ratio + speaker_ratio) / 2 AS score_1
  FROM edges WHERE edge WINDOW p AS (PARTITION BY recording, speech_id, label)
), one AS (
  SELECT *, (end_segment_ms - start_segment_ms) / duration_text AS lr FROM wide QUALIFY row_number() OVER (PARTITION BY recording, label, speech_id ORDER BY score_1 DESC, start_ms, run_id) = 1
), two AS (
  SELECT *, (overlap_ratio + speaker_ratio + CASE WHEN lr > 1 THEN 1 / (lr * lr) ELSE lr END) / 3 AS s FROM one
), best AS (
  SELECT * FROM (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY recording, speech_id ORDER BY s DESC, start_segment_ms, label) = 1) WHERE s > 0.5
)
SELECT recording, speech_id, label, start_segment_ms, end_segment_ms, end_segment_ms - start_segment_ms AS duration_segment_ms, round(s, 6) AS overall_score, nr_speech_segments,
  coalesce(start_segment_ms = lag(start_segment_ms) OVER n, false) OR coalesce(start_segment_ms = lead(start_segment_ms) OVER n, false) AS start_segment_same
FROM best WINDOW n AS (PARTITION BY recording ORDER BY start_segment_ms, speech_id)""")
def refine_speeches(spark: SparkSession, d: str) -> DataFrame:
    segments = event_segments(spark, d)
    return refine.refine(segments.drop("value"), day_speeches(segments), bucket_ms=DAY)


OVERLAPS = f"""WITH {SEGMENTS} SELECT recording, pos, speech_id, least(end_ms, b_end_ms) - greatest(start_ms, b_start_ms) AS overlap_ms
FROM segments JOIN speeches USING (recording) WHERE least(end_ms, b_end_ms) - greatest(start_ms, b_start_ms) > 0"""


@query(OVERLAPS)
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    segments = event_segments(spark, d)
    return intervals.overlap_join(segments, day_speeches(segments), "recording").select("recording", "pos", "speech_id", "overlap_ms")


@query(OVERLAPS)
def overlap_pairs_bucketed(spark: SparkSession, d: str) -> DataFrame:
    segments = event_segments(spark, d)
    return intervals.overlap_join(segments, day_speeches(segments), "recording", bucket_ms=DAY).select("recording", "pos", "speech_id", "overlap_ms")


def _ranges(spark: SparkSession, d: str) -> DataFrame:
    """Sittings: the span of dates of each priority and month."""
    o = load(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return o.groupBy(F.col("o_orderpriority").alias("sitting"), F.trunc("day", "month").alias("month")).agg(F.min("day").alias("date_start"), F.date_add(F.min("day"), 3).alias("date_end"))


_SITTINGS = "sittings AS (SELECT o_orderpriority AS sitting, date_trunc('month', o_orderdate)::DATE AS month, min(o_orderdate::DATE) AS date_start, min(o_orderdate::DATE) + 3 AS date_end FROM orders GROUP BY ALL)"


@query(f"WITH {_SITTINGS} SELECT o_orderkey, sitting, CAST(date_start AS VARCHAR) AS date_start FROM orders JOIN sittings ON o_orderdate::DATE BETWEEN date_start AND date_end")
def date_range_join(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return intervals.date_range_join(o, _ranges(spark, d), "day", "date_start", "date_end").select("o_orderkey", "sitting", F.col("date_start").cast("string").alias("date_start"))


@query(f"""WITH {_SITTINGS} SELECT o_orderkey, sitting FROM orders JOIN sittings ON o_orderdate::DATE BETWEEN date_start - 21 AND date_end + 21 AND o_orderpriority = sitting
QUALIFY row_number() OVER (PARTITION BY o_orderkey, sitting ORDER BY date_start) = 1""")
def date_range_join_widened(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    wide = intervals.date_range_join(o, _ranges(spark, d), "day", "date_start", "date_end", 21).where("o_orderpriority = sitting")
    return keys.first_per_key(wide, ["o_orderkey", "sitting"], "date_start").select("o_orderkey", "sitting")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem, (SELECT min(o_orderdate)::DATE - 7 AS lo, max(o_orderdate)::DATE + 7 AS hi FROM orders WHERE o_orderstatus = 'F')
WHERE l_shipdate::DATE > lo AND l_shipdate::DATE < hi AND year(l_shipdate) BETWEEN 1994 AND 1995""")
def date_window(spark: SparkSession, d: str) -> DataFrame:
    """The year range is written as one of dates, so that it is pushed to the scan."""
    l = load(spark, d, "lineitem").where("l_shipdate >= TIMESTAMP_NTZ'1994-01-01' AND l_shipdate < TIMESTAMP_NTZ'1996-01-01'").withColumn("day", F.to_date("l_shipdate"))  # noqa: E741
    o = load(spark, d, "orders").where("o_orderstatus = 'F'").withColumn("day", F.to_date("o_orderdate"))
    return intervals.within_days(l, "day", o, "day").select("l_orderkey", "l_linenumber")


def _paths(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.concat(F.lit("data/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("path"))


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti(spark: SparkSession, d: str) -> DataFrame:
    done = load(spark, d, "labels").select(F.concat(F.lit("out/x/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("done"))
    return keys.not_done(_paths(spark, d), done, "path", "done").select("doc_id")


@query("SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_semi(spark: SparkSession, d: str) -> DataFrame:
    done = load(spark, d, "labels").select(F.concat(F.lit("out/x/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("done"))
    return keys.only_done(_paths(spark, d), done, "path", "done").select("doc_id")


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS score, CASE WHEN l_discount > 0.05 THEN l_quantity END AS s, CASE WHEN l_tax > 0.02 THEN l_tax END AS e,
  count(*) OVER (PARTITION BY l_orderkey) > 1 AS many FROM lineitem)
SELECT l_orderkey, l_linenumber, score FROM c WHERE NOT (many AND (s IS NULL OR e IS NULL)) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber) = 1""")
def ambiguous_filter_argmax(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("score"), F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("s"), F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("e"))
    return keys.best_per_key(keys.drop_ambiguous(c, ["l_orderkey"], ["s", "e"]), ["l_orderkey"], "score", "l_linenumber").select("l_orderkey", "l_linenumber", "score")


@query("""SELECT user_id, arg_min(event_type, event_id) FILTER (WHERE event_type <> 'view') AS first_type, arg_min(value, event_id) FILTER (WHERE value > 100) AS first_value FROM events GROUP BY user_id""")
def first_nonnull_per_key(spark: SparkSession, d: str) -> DataFrame:
    e = load(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("first_type"), F.when(F.col("value") > 100, F.col("value")).alias("first_value"))
    return keys.first_values(e, ["user_id"], "event_id")


@query("SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments, min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer GROUP BY ALL")
def distinct_join_per_key(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").groupBy("c_nationkey").agg(keys.distinct_text("c_mktsegment").alias("segments"), F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS turns FROM conversations GROUP BY conv_id")
def ordered_concat(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversations").groupBy("conv_id").agg(keys.ordered_text("turn", "text").alias("text"), F.count(F.lit(1)).alias("turns"))


_WORDS = "list_filter(string_split_regex(text, '[\\t\\n\\x0b\\x0c\\r ]+'), lambda x: x <> '')"


@query(f"SELECT conv_id, turn, CAST(unnest(range(len(w))) AS BIGINT) AS word_index, unnest(w) AS word FROM (SELECT conv_id, turn, {_WORDS} AS w FROM conversations)")
def word_index(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations").withColumn("k", F.struct("conv_id", "turn"))
    return words.word_table(c, "k", "text").select("k.conv_id", "k.turn", F.col("word_index").cast("long"), "word")


def _timed(spark: SparkSession, d: str) -> DataFrame:
    """Each turn's words at ten a second, with a pause of 50 ms after each."""
    w = F.filter(F.split("text", r"[\t\n\x0B\f\r ]+"), lambda x: x != "")
    return load(spark, d, "conversations").select("conv_id", "turn", F.transform(w, lambda x, i: F.struct(x.alias("word"), (i * 100).alias("start_time"), (i * 100 + 50).alias("end_time"))).alias("w"))


@query(f"""WITH t AS (SELECT conv_id, turn, {_WORDS} AS w FROM conversations), i AS (SELECT *, CASE WHEN len(w) > 0 THEN least(3, len(w) - 1) END AS a, CASE WHEN len(w) > 0 THEN least(8, len(w) - 1) END AS b FROM t)
SELECT conv_id, turn, CAST(a AS BIGINT) AS first, CAST(b AS BIGINT) AS last, CASE WHEN b IS NOT NULL THEN array_to_string(list_slice(w, a + 1, b + 1), ' ') END AS slice FROM i""")
def word_slice(spark: SparkSession, d: str) -> DataFrame:
    t = _timed(spark, d)
    return t.select("conv_id", "turn", words.index_at("w", F.lit(275)).alias("first"), words.index_at("w", F.lit(820)).alias("last"), words.text_between("w", F.lit(275), F.lit(820)).alias("slice"))


_LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(f"WITH {_LINES} SELECT line, count(*) AS n FROM lines WHERE line <> '' GROUP BY line ORDER BY n DESC, line LIMIT 100")
def top_lines(spark: SparkSession, d: str) -> DataFrame:
    """The feature is the report of the commonest lines."""
    lines = load(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return keys.top_groups(lines, "line", 100)


@query(f"""WITH {_LINES}, numbered AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
common AS (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(*) >= 5)
SELECT doc_id, string_agg(line, ' ' ORDER BY pos) AS text FROM numbered WHERE line NOT IN (SELECT line FROM common) GROUP BY doc_id""")
def common_lines_dropped(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").withColumn("html", F.concat(F.lit("<p>"), F.replace("text", F.lit("\n"), F.lit("</p><p>")), F.lit("</p>")))
    lines = docs.select(F.explode(F.split("text", "\n")).alias("header")).where("header <> ''").groupBy("header").count().where("count >= 5")
    return cleaning.without_headers(docs, "doc_id", "html", lines)


@query("""WITH c AS (SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k FROM c)
SELECT user_id, event_type, n FROM r WHERE k <= 2 OR event_type = 'purchase'""")
def top_n_plus_pinned(spark: SparkSession, d: str) -> DataFrame:
    counts = load(spark, d, "events").groupBy("user_id", "event_type").count()
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "count"))).alias("m"))
    return maps.select("user_id", F.explode(keys.top_entries("m", 2, "purchase")).alias("event_type", "n"))


@query(f"""WITH {SEGMENTS}, m AS (SELECT recording, pos, start_ms, end_ms, lag(end_ms) OVER w AS pe, lead(start_ms) OVER w AS ns FROM segments WINDOW w AS (PARTITION BY recording ORDER BY start_ms, end_ms))
SELECT recording, pos, CASE WHEN CASE WHEN pe IS NULL THEN start_ms - 50 > 0 ELSE start_ms - pe > 100 END THEN start_ms - 50 ELSE start_ms END AS start_ms, CASE WHEN ns - end_ms > 50 THEN end_ms + 50 ELSE end_ms END AS end_ms FROM m""")
def margins(spark: SparkSession, d: str) -> DataFrame:
    return chunking.with_margin(event_segments(spark, d).select("recording", "pos", "start_ms", "end_ms"), ["recording"], 50, "start_ms", "end_ms")


_SILENCES = f"""{SEGMENTS}, m AS (SELECT recording, start_ms, end_ms, label, lag(end_ms) OVER (PARTITION BY recording ORDER BY start_ms, end_ms) AS pe FROM segments), subs AS (
  SELECT recording, start_ms, end_ms, label AS text FROM m UNION ALL SELECT recording, pe, start_ms, '<|silence|>' FROM m WHERE pe <> start_ms)"""


@query(f"WITH {_SILENCES} SELECT recording, start_ms, end_ms, text, end_ms - start_ms AS duration_ms, end_ms - start_ms > 30000 AS is_long FROM subs")
def margin_silence(spark: SparkSession, d: str) -> DataFrame:
    return chunking.with_silences(event_segments(spark, d).select("recording", "start_ms", "end_ms", F.col("label").alias("text")), ["recording"])


@query(f"""WITH RECURSIVE {SEGMENTS}, o AS (SELECT recording, pos, end_ms - start_ms AS size, row_number() OVER (PARTITION BY recording ORDER BY pos) AS k FROM segments), f AS (
  SELECT recording, pos, k, size AS total, 0 AS chunk FROM o WHERE k = 1
  UNION ALL SELECT o.recording, o.pos, o.k, CASE WHEN f.total > 0 AND f.total + o.size > 600000 THEN o.size ELSE f.total + o.size END, CASE WHEN f.total > 0 AND f.total + o.size > 600000 THEN f.chunk + 1 ELSE f.chunk END FROM f JOIN o ON o.recording = f.recording AND o.k = f.k + 1)
SELECT recording, pos, CAST(chunk AS BIGINT) AS chunk FROM f""")
def pack_greedy(spark: SparkSession, d: str) -> DataFrame:
    s = event_segments(spark, d).withColumn("size", F.col("end_ms") - F.col("start_ms"))
    packed = s.groupBy("recording").agg(chunking.greedy_chunk_ids("pos", "size", 600_000).alias("c"))
    return packed.select("recording", F.inline("c")).withColumn("chunk", F.col("chunk").cast("long"))


@query()
def pack_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Turns as sentences, 60 ms a character: chunks of 10 to 30 s."""
    c = load(spark, d, "conversations").withColumn("ms", F.length("text").cast("long") * 60)
    end = F.sum("ms").over(Window.partitionBy("conv_id").orderBy("turn"))
    subs = c.withColumn("end_ms", end).withColumn("start_ms", F.col("end_ms") - F.col("ms")).select("conv_id", "start_ms", "end_ms", "text")
    return chunking.pack_chunks(subs, "conv_id").drop("sub_ids")


_HOUR = 3_600_000


@query(f"""WITH {SEGMENTS}, m AS (SELECT recording, pos, start_ms, CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY recording ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 3600000 THEN 0 ELSE 1 END AS fresh, end_ms FROM segments)
SELECT recording, pos, CAST(sum(fresh) OVER (PARTITION BY recording ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM m""")
def sessions_gap(spark: SparkSession, d: str) -> DataFrame:
    return intervals.sessions_by_gap(event_segments(spark, d), ["recording"], _HOUR).select("recording", "pos", "session_id")


@query(f"""WITH {SEGMENTS}, p AS (SELECT recording, start_ms - 1000 AS s, end_ms + 1000 AS e FROM segments), m AS (
  SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY recording ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 600000 THEN 0 ELSE 1 END AS fresh FROM p), i AS (
  SELECT *, sum(fresh) OVER (PARTITION BY recording ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT recording, min(s) AS start_ms, max(e) AS end_ms FROM i GROUP BY recording, island HAVING max(e) - min(s) >= 60000""")
def merged_intervals(spark: SparkSession, d: str) -> DataFrame:
    return intervals.union_intervals(event_segments(spark, d).select("recording", "start_ms", "end_ms"), ["recording"], 600_000, 1000, 60_000)


@query("SELECT user_id, min(ts) AS first_ts, CAST(count(*) AS BIGINT) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, k")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    return stream_sessions.sessions(load(spark, d, "events"), "user_id", gap="6 hours").select("user_id", F.col("start").cast("timestamp_ntz").alias("first_ts"), "n")


@query(f"""WITH RECURSIVE {SEGMENTS}, o AS (SELECT recording, start_ms AS s, end_ms AS e, label, row_number() OVER (PARTITION BY recording ORDER BY start_ms, end_ms) AS k FROM segments), f AS (
  SELECT recording, k, s AS first_ms, e AS last_ms, 0 AS span FROM o WHERE k = 1
  UNION ALL SELECT o.recording, o.k, CASE WHEN o.s - f.last_ms >= 3600000 OR o.e - f.first_ms > 14400000 THEN o.s ELSE f.first_ms END, o.e,
    CASE WHEN o.s - f.last_ms >= 3600000 OR o.e - f.first_ms > 14400000 THEN f.span + 1 ELSE f.span END FROM f JOIN o ON o.recording = f.recording AND o.k = f.k + 1),
spans AS (SELECT recording, span, min(first_ms) AS s, arg_max(last_ms, k) AS e FROM f GROUP BY ALL), g AS (
  SELECT recording, span, s AS begin, 0 AS session_id FROM spans WHERE span = 0
  UNION ALL SELECT spans.recording, spans.span, CASE WHEN spans.e - g.begin >= 14400000 THEN spans.s ELSE g.begin END, CASE WHEN spans.e - g.begin >= 14400000 THEN g.session_id + 1 ELSE g.session_id END FROM g JOIN spans ON spans.recording = g.recording AND spans.span = g.span + 1)
SELECT recording, CAST(session_id AS BIGINT) AS session_id, min(o.s) AS start_ms, max(o.e) AS end_ms, string_agg(label, ' ' ORDER BY k) AS text FROM o JOIN f USING (recording, k) JOIN g USING (recording, span) GROUP BY recording, session_id""")
def sessions_capped(spark: SparkSession, d: str) -> DataFrame:
    w = event_segments(spark, d).select("recording", "start_ms", "end_ms", F.col("label").alias("word"))
    return chunking.sessionised(w, "recording", _HOUR, 4 * _HOUR)


@query(f"""WITH {SEGMENTS}, s AS (SELECT recording, pos, sum(end_ms - start_ms) OVER (ORDER BY start_ms, pos ROWS UNBOUNDED PRECEDING) AS total FROM segments)
SELECT recording, pos, lpad(CAST(CAST(floor(total / 3.6e6 / 25) AS BIGINT) AS VARCHAR), 4, '0') AS shard FROM s""")
def shard_running_sum(spark: SparkSession, d: str) -> DataFrame:
    s = event_segments(spark, d).withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    return shards.shard_ids(s, ["start_ms", "pos"], "duration_ms").select("recording", "pos", "shard")  # of all columns


@query("""SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS chunk_id, CASE WHEN lag(turn) OVER w + 1 = turn AND lag(text) OVER w NOT IN ('', '<|nospeech|>') THEN lag(text) OVER w END AS previous_text
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def previous_texts(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations").withColumns({"start_ms": F.col("turn"), "end_ms": F.col("turn") + 1})
    numbered = shards.chunk_ids(c, "conv_id", "turn").withColumn("chunk_id", F.col("chunk_id").cast("long"))
    return numbered.withColumn("previous_text", shards.previous_text(["conv_id"], "turn")).select("conv_id", "turn", "chunk_id", "previous_text")


@query("""WITH a AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n_all FROM lineitem GROUP BY 1), b AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS year, count(*) AS n_matched, sum(CAST(l_quantity AS BIGINT)) / 3600 AS hours FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT year, n_all, n_matched, hours, n_matched / n_all AS match_fraction FROM a JOIN b USING (year)""")
def year_report(spark: SparkSession, d: str) -> DataFrame:
    l = load(spark, d, "lineitem").withColumn("seconds", F.col("l_quantity").cast("long"))  # noqa: E741
    return report.by_year(l, l.where("l_returnflag = 'R'"), "l_shipdate", "seconds")


@query("""SELECT page_id, replace(trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\([^)]*\\)', '', 'g'), '[\\t\\n\\x0b\\x0c\\r ]+', ' ', 'g'), ' '), '&amp;', '&') AS text FROM pages""")
def html_clean(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").select("page_id", cleaning.clean_protocol(F.col("html"), normalise=False).alias("text"))


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text, '\\*[^*]*\\*', '', 'g'), '\\[[^\\]]*\\]', '', 'g'), '[\\t\\n\\x0b\\x0c\\r ]+', ' ', 'g'), ' ') AS text FROM documents""")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", cleaning.trimmed(cleaning.replaced(F.col("text"), (r"\*[^*]*\*", ""), (r"\[[^\]]*\]", ""))).alias("text"))


@query()
def chunk_clean(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", cleaning.clean_chunk(F.col("text")).alias("text"))


@query("""SELECT event_id, regexp_replace('<' || printf('%.2f', (CAST(round(value * 1000) AS BIGINT) // 20 * 20) / 1000.0 % 90) || '> ' || event_type, '<(\\d{1,2}\\.\\d{2})>', '<|\\1|>', 'g') AS tagged FROM events""")
def tag_rewrite(spark: SparkSession, d: str) -> DataFrame:
    ms = F.round(F.col("value") * 1000).cast("long") % 90_000
    return load(spark, d, "events").select("event_id", cleaning.piped_tags(F.concat(times.whisper_time(ms), F.lit(" "), F.col("event_type"))).alias("tagged"))


@query("""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS last, array_to_string(list_slice(string_split(url, '/'), greatest(len(string_split(url, '/')) - 1, 1), len(string_split(url, '/'))), '/') AS last_two, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM pages""")
def url_and_path_parts(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").select("page_id", keys.basename("url").alias("last"), cleaning.last_parts(F.col("url")).alias("last_two"), cleaning.stem(F.col("url")).alias("stem"))


@query("""SELECT o_orderkey, array_to_string(regexp_extract_all('rec_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || '.mp3', '(\\d{4}-\\d{2}-\\d{2})', 1), ',') AS dates FROM orders""")
def dates_in_text(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("rec_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM-dd"), F.lit(".mp3"))
    return load(spark, d, "orders").select("o_orderkey", F.array_join(cleaning.dates_in(name), ",").alias("dates"))


_MS = "CAST(round(l_extendedprice * 1000) AS BIGINT)"


@query(f"""SELECT l_orderkey, l_linenumber, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS srt, printf('%02d:%02d:%02d', ms // 1000 % 86400 // 3600, ms // 60000 % 60, ms // 1000 % 60) AS clock,
  CASE WHEN (ms * 16) % 480000 = 0 THEN 0 WHEN (ms * 16) % 480000 < 400 THEN 1 ELSE ((ms * 16) % 480000 - 80) // 320 END + (ms * 16) // 480000 * 1499 AS logits FROM (SELECT l_orderkey, l_linenumber, {_MS} AS ms FROM lineitem)""")
def timestamps_format(spark: SparkSession, d: str) -> DataFrame:
    ms = F.round(F.col("l_extendedprice") * 1000).cast("long")
    l = load(spark, d, "lineitem").withColumn("ms", ms)  # noqa: E741
    s = F.col("ms").cast("decimal(20,3)") / 1000
    return l.select("l_orderkey", "l_linenumber", times.srt_timestamp(s).alias("srt"), times.clock(s).alias("clock"), times.ctc_length(F.col("ms") * 16).alias("logits"))


@query("SELECT l_orderkey, l_linenumber, CAST(round_even((l_tax + l_quantity / 2048) * 1000, 0) AS BIGINT) AS ms FROM lineitem")
def half_even_ms(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", times.seconds_to_ms(F.col("l_tax") + F.col("l_quantity") / 2048).alias("ms"))


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, json_extract_string(props, '$.ref') AS ref, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select("event_id", *(F.get_json_object("props", f"$.{c}").alias(c) for c in ("page", "ref", "k")))


@query("""SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY turn) || CASE WHEN bool_or(role = 'assistant') THEN '' ELSE chr(10) || 'assistant:new' END AS appended,
  coalesce(string_agg(role || ':' || text, chr(10) ORDER BY turn) FILTER (WHERE role <> 'assistant') || chr(10), '') || 'assistant:new' AS replaced, 'assistant:new' AS alone, arg_max(text, turn) FILTER (WHERE role = 'user') AS last_user FROM conversations GROUP BY conv_id""")
def model_upsert(spark: SparkSession, d: str) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text", F.col("role").alias("model")))), lambda x: F.struct(x["text"].alias("text"), x["model"].alias("model")))
    c = load(spark, d, "conversations").groupBy("conv_id").agg(listed.alias("r"))
    new = F.struct(F.lit("new").alias("text"), F.lit("assistant").alias("model"))
    show = lambda r: F.array_join(F.transform(r, lambda x: F.concat(x["model"], F.lit(":"), x["text"])), "\n")
    return c.select("conv_id", *(show(upsert.upserted("r", new, mode)).alias(n) for n, mode in (("appended", "append"), ("replaced", "model"), ("alone", "all"))), upsert.by_model("r", "user").alias("last_user"))


@query("""WITH p AS (SELECT a.conv_id, a.turn, regexp_replace(a.text, '[^ -~]', '', 'g') AS x, regexp_replace(b.text, '[^ -~]', '', 'g') AS y FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CASE WHEN x = '' AND y = '' THEN 0 ELSE levenshtein(x[:10], y[:10]) / greatest(len(x[:10]), len(y[:10])) END AS head, CASE WHEN x = '' AND y = '' THEN 0 ELSE levenshtein(right(x, 10), right(y, 10)) / greatest(len(right(x, 10)), len(right(y, 10))) END AS tail FROM p""")
def cer_head_tail(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations").withColumn("x", F.regexp_replace("text", "[^ -~]", ""))
    p = c.select("conv_id", "turn", "x").join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("x").alias("y")), ["conv_id", "turn"])
    return p.select("conv_id", "turn", cleaning.head_error(F.col("x"), F.col("y")).alias("head"), cleaning.tail_error(F.col("x"), F.col("y")).alias("tail"))


def _turn_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations").select("conv_id", "turn", "text")
    return c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other")), ["conv_id", "turn"])


@query()
def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    """BLEU, word error and end ratios of neighbouring turns."""
    pairs = _turn_pairs(spark, d)
    scores = {"bleu": similarity.bleu_udf, "overlap_bleu": similarity.overlap_bleu_udf, "wer": similarity.word_error_udf, "ratio": similarity.ratio_udf, "first_word": similarity.first_word_udf, "last_word": similarity.last_word_udf}
    return pairs.select("conv_id", "turn", *(F.round(f("text", "other"), 6).alias(n) for n, f in scores.items()))


@query(f"SELECT word, row_number() OVER (ORDER BY word) AS id FROM (SELECT DISTINCT unnest({_WORDS}) AS word FROM conversations)")
def vocab_ids(spark: SparkSession, d: str) -> DataFrame:
    return words.vocabulary(load(spark, d, "conversations"), "text")


@query(f"""WITH v AS (SELECT word, row_number() OVER (ORDER BY word) AS id FROM (SELECT DISTINCT unnest({_WORDS}) AS word FROM benchmark)), w AS (SELECT conv_id, turn, unnest(range(len(l))) AS word_index, unnest(l) AS word FROM (SELECT conv_id, turn, {_WORDS} AS l FROM conversations))
SELECT conv_id, turn, CAST(word_index AS BIGINT) AS word_index, coalesce(id, 0) AS id FROM w LEFT JOIN v USING (word)""")
def oov_encode(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations").withColumn("k", F.struct("conv_id", "turn"))
    coded = words.encoded_words(c, "k", "text", words.vocabulary(load(spark, d, "benchmark"), "text"))
    return coded.select("k.conv_id", "k.turn", F.col("word_index").cast("long"), "id")


#: 5-grams are looked up in Python's tables up to so many (some 50 MB a worker), their hashes are broadcast up to so many
#: (some 100 MB), and joined by a shuffle beyond.
LOOKED_UP_GRAMS, BROADCAST_GRAMS = 200_000, 2_000_000


def _grams(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Each gram as two 64-bit hashes: the texts' words needn't be sent anywhere."""
    w = F.filter(F.split("text", r"[\t\n\x0B\f\r ]+"), lambda x: x != "")
    listed = df.select(key, w.alias("w")).where(F.size("w") >= n)
    part = lambda i: F.slice("w", i, F.lit(n))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(F.xxhash64(part(i)).alias("a"), F.xxhash64(part(i), F.lit(1)).alias("b")))
    return listed.select(key, F.posexplode(grams).alias("i", "g")).select(key, "i", "g.a", "g.b")


@query(f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dg AS (SELECT doc_id, i - 1 AS i, array_to_string(list_slice(w, i, i + 4), ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d)),
bg AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 4), ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM b))
SELECT doc_id, item_id, count(*) AS hits, CAST(min(i) AS BIGINT) AS first FROM dg JOIN bg USING (gram) GROUP BY ALL""")
def ngram_hits(spark: SparkSession, d: str) -> DataFrame:
    bench = stored(_grams(load(spark, d, "benchmark"), "item_id").select("item_id", "a", "b").distinct())
    n = bench.count()
    if n <= LOOKED_UP_GRAMS:
        passages = load(spark, d, "benchmark").select("item_id", "text").where("text IS NOT NULL").distinct().collect()
        found = matching.gram_hits(load(spark, d, "documents"), "doc_id", "text", [tuple(x) for x in passages], "item_id", bench.schema["item_id"].dataType)
        return found.groupBy("doc_id", "item_id").agg(F.sum("hits").alias("hits"), F.min("first").alias("first"))
    few = n <= BROADCAST_GRAMS
    hits = _grams(load(spark, d, "documents"), "doc_id").join(F.broadcast(bench) if few else bench, ["a", "b"])
    return hits.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("hits"), F.min("i").cast("long").alias("first"))


@query()
def fuzzy_locate(spark: SparkSession, d: str) -> DataFrame:
    """Each benchmark passage in the documents that share five words in a row with it (what shares none can't be a near copy)."""
    pairs = ngram_hits(spark, d).select("doc_id", "item_id")
    docs, items = load(spark, d, "documents").select("doc_id", "text"), load(spark, d, "benchmark").select("item_id", F.col("text").alias("needle"))
    both = pairs.join(docs, "doc_id").join(items, "item_id")
    flat = F.trim(F.regexp_replace("text", r"\s+", " "))
    return both.select("doc_id", "item_id", similarity.locate_udf()("needle", flat).alias("m")).select("doc_id", "item_id", "m.*")


@query()
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", normalise.normalize_udf("sv")("text").alias("text"))


@query()
def span_provenance(spark: SparkSession, d: str) -> DataFrame:
    spans = load(spark, d, "benchmark").select("item_id", F.explode(normalise.spans_udf("sv")("text")).alias("s"))
    return spans.select("item_id", "s.index", "s.original_start", "s.original_end", "s.replacement", "s.normalized_start", "s.normalized_end")


@query()
def classified_tokens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "benchmark").select("item_id", F.explode(tokens.classified_udf("sv")("text")).alias("t")).groupBy("item_id", "t.type").count()


@query("""WITH w AS (SELECT ['ett', 'två', 'tre', 'fyra', 'fem', 'sex', 'sju', 'åtta', 'nio', 'tio', 'elva', 'tolv', 'tretton', 'fjorton', 'femton', 'sexton', 'sjutton', 'arton', 'nitton'] AS low, ['tjugo', 'trettio', 'fyrtio', 'femtio', 'sextio', 'sjuttio', 'åttio', 'nittio'] AS tens)
SELECT DISTINCT p_size, CASE WHEN p_size < 20 THEN low[p_size] ELSE tens[p_size // 10 - 1] || coalesce(low[nullif(p_size % 10, 0)], '') END AS words FROM part, w""")
def number_words(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "part").select("p_size").distinct().select("p_size", numbers_sv.cardinal_udf("p_size").alias("words"))


@query()
def voice_stretches(spark: SparkSession, d: str) -> DataFrame:
    """Event values as activity scores, one a second."""
    s = load(spark, d, "events").select("user_id", "event_id", (F.col("value") / 500).alias("score"))
    return voice.active_stretches(s, "user_id", "event_id", "score", 1.0, onset=0.5, offset=0.2, max_duration=20.0)


@query("SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, ''), c_name) AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE' ELSE c_mktsegment END AS segment, c_acctbal IS NOT NULL AS known, upper(c_name) AS upper_name FROM customer")
def recoded(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").withColumn("nick", cleaning.null_if_empty(F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))))
    c = keys.coalesced(c.withColumn("full", F.col("c_name")), "nick", "full")
    return c.select("c_custkey", F.col("nick").alias("name"), F.when(F.col("c_mktsegment") == "BUILDING", "HOUSE").otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").isNotNull().alias("known"), F.upper("c_name").alias("upper_name"))


@query("""SELECT c_custkey, c_name, n_name, r_name, o.n AS orders FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def enriched(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = (load(spark, d, t) for t in ("customer", "nation", "region"))
    o = load(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_name", "n_name", "r_name", "orders")


@query("""SELECT key, kind FROM (SELECT c_name AS key, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier UNION ALL SELECT c_name, 'customer' FROM customer WHERE c_acctbal < 0) GROUP BY ALL""")
def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    a = c.select(F.col("c_name").alias("key"), F.lit("customer").alias("kind"))
    b = load(spark, d, "supplier").select(F.col("s_name").alias("key"), F.lit("supplier").alias("kind"))
    return a.unionByName(b).unionByName(c.where("c_acctbal < 0").select(F.col("c_name").alias("key"), F.lit("customer").alias("kind"))).distinct()


@query("SELECT l_orderkey, count(*) AS n_rows, sum(CASE WHEN w <> 'R' THEN 1 ELSE 0 END)::BIGINT AS spoken FROM (SELECT l_orderkey, l_returnflag AS w FROM lineitem) GROUP BY 1")
def exploded_nested(spark: SparkSession, d: str) -> DataFrame:
    """Documents of lines, nested and flattened again."""
    from .sources.readers import flattened

    docs = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("chunks")).select(F.struct("l_orderkey").alias("metadata"), "chunks")
    flat = flattened(docs)
    return flat.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col("l_returnflag") != "R", 1).otherwise(0)).alias("spoken"))


@query("SELECT vec_id, 70::BIGINT AS n, CAST(embedding[64] AS DOUBLE) AS last, 0.0::DOUBLE AS fill, CAST(embedding[20] AS DOUBLE) AS cut, CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS top FROM embeddings")
def vector_shapes(spark: SparkSession, d: str) -> DataFrame:
    wide, short = times.padded(F.col("embedding"), 70), times.padded(F.col("embedding"), 20)
    one = lambda c, i: F.element_at(c, i).cast("double")
    return load(spark, d, "embeddings").select("vec_id", F.size(wide).cast("long").alias("n"), one(wide, 64).alias("last"), one(wide, 70).alias("fill"), one(short, -1).alias("cut"), F.array_position("embedding", F.array_max("embedding")).alias("top"))


@query("SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 1000 AS BIGINT) AS batch FROM events")
def row_batches(spark: SparkSession, d: str) -> DataFrame:
    return vectors.batches(load(spark, d, "events"), "event_id", 1000).select("event_id", F.col("batch").cast("long").alias("batch"))


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) > 1 AS several, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_date, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS number FROM orders")
def per_key_windows(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey")
    number = F.row_number().over(w.orderBy("o_orderdate", "o_orderkey")).cast("long")
    return load(spark, d, "orders").select("o_orderkey", keys.multiple(["o_custkey"]).alias("several"), F.min("o_orderdate").over(w).alias("first_date"), number.alias("number"))


from . import catalog_pieces  # noqa: E402, F401 - adds its queries
