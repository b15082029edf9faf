"""Kernels against brute force, loops and hand-made values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.functions import cleaning, normalise, numbers_sv, similarity, times, tokens
from talkweave.functions.lexicon import plain, sv
from talkweave.operators import chunking, intervals, keys, matching, runs, shards, slots, upsert, vectors, voice, words


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_subsequence_and_partial_alignment():
    r = random.Random(0)
    for _ in range(300):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(0, 14))) for _ in range(2))
        assert similarity.lcs_length(a, b) == brute_lcs(a, b)
        if a and b:
            score, s, e = similarity.partial_alignment(a, b)
            short, long = sorted((a, b), key=len)
            if len(b) <= len(a):
                short, long = b, a
            m, n = len(short), len(long)
            cuts = [(i, i + m) for i in range(n - m + 1)] + [(0, k) for k in range(1, m)] + [(i, n) for i in range(max(n - m + 1, 1), n)]
            assert score == pytest.approx(max(200 * brute_lcs(short, long[i:j]) / (m + j - i) for i, j in cuts))


def test_scores():
    assert similarity.ratio("", "") == 100 and similarity.ratio("abc", "abd") == pytest.approx(200 * 2 / 6)
    assert similarity.word_error("a b c", "a x c d") == pytest.approx(2 / 3)
    assert similarity.word_error("", "a") is None and similarity.word_error(None, "a") is None
    assert similarity.bleu("the cat sat on the mat", "the cat sat on the mat") == pytest.approx(1)
    assert similarity.bleu("a b", "c d") == 0 and similarity.bleu(None, "a") is None and similarity.bleu("a", "") == 0
    assert 0 < similarity.bleu("the cat sat on a mat", "the dog sat on a mat") < 1
    assert similarity.bleu("a b c d e f g h", "a b c d e") == pytest.approx(np.exp(1 - 8 / 5))
    assert similarity.edit_distance("kitten", "sitting") == 3


def test_locating():
    r = random.Random(3)
    say = lambda n: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 8))) for _ in range(n)]
    before, speech, after = say(50), say(30), say(40)
    text = " ".join([*before, *speech, *after])
    spoken = [w if k % 9 else w[:-1] + "q" for k, w in enumerate(speech)]
    start, end, score = similarity.locate(" ".join(spoken), text)
    assert (start, end) == (50, 80) and score > 90
    assert similarity.locate(" ".join(spoken), text, compat=True)[1] == 79
    long = say(400)
    assert similarity.locate(" ".join(long), " ".join([*before, *long, *after]), max_words=20)[:2] == (50, 450)
    assert similarity.locate("zzz qqq", "one word") == (None, None, None)
    assert similarity.locate(None, text) == (None, None, None) == similarity.locate("a", "single")
    s, e, _ = similarity.ngram_locate(" ".join(speech), text)
    assert abs(s - 50) <= 3 and abs(e - 80) <= 3
    assert similarity.ngram_locate("x", "y z") == (None, None, None)


def test_swedish_numbers():
    want = {0: "noll", 1: "ett", 12: "tolv", 21: "tjugoett", 100: "etthundra", 101: "etthundraett", 342: "trehundrafyrtiotvå", 1000: "ettusen", 1966: "ettusenniohundrasextiosex", 2_000_000: "två miljoner", 1_000_001: "en miljon ett", -3: "minus tre"}
    assert {n: numbers_sv.cardinal(n) for n in want} == want
    assert [numbers_sv.ordinal(n) for n in (1, 2, 3, 7, 20, 21, 30)] == ["första", "andra", "tredje", "sjunde", "tjugonde", "tjugoförsta", "trettionde"]


def test_normalisation():
    say = numbers_sv.cardinal
    cases = {
        "Det är bl.a. 5%": "det är bland annat femprocent", "EU-politiska": "eupolitiska", "4 kap. 7 §": "fjärde kapitlet sjunde paragrafen",
        "kl. 10:30": f"kl {say(10)} {say(30)}", "sidan 101-105": f"sidan {say(101)} till {say(105)}", "3,5": "tre komma fem", "§ 7": "paragraf sju", "": "", " - ": "",
    }
    for text, want in cases.items():
        assert normalise.normalize_text(text) == want, text
    assert normalise.normalize_text(None) is None and normalise.normalize_text("A, b!", plain) == "a b"


def test_span_provenance():
    for text in ("Herr talman! Det är bl.a. 5 % (skratt) av 4 kap. 7 §.", "  två   ord ", "", "1 000 kr, 10:30 och 101-105", "bl. a. detta"):
        out, spans, corrected = normalise.normalize_with_spans(text)
        assert all(out[s.normalized_start : s.normalized_end] == s.replacement for s in spans)
        assert all(corrected[s.original_start : s.original_end] == s.original_token for s in spans)
        assert all(a.original_end <= b.original_start for a, b in zip(spans, spans[1:])) and [s.index for s in spans] == list(range(len(spans)))
        assert "".join(t["token"] for t in normalise.normalized_tokens(spans)) == "".join(out.upper().split())
    multi = [t for t in normalise.normalized_tokens(normalise.normalize_with_spans("bl.a.")[1])]
    assert [t["token"] for t in multi] == ["BLAND", "ANNAT"] and multi[0]["is_first_word"] and multi[1]["is_last_word"]


def test_token_classes():
    got = [(w.text, w.type) for w in tokens.words("Kl. 10:30, EU och 1 000 kr t.ex. (3,5 %) x2 4.", sv)]
    assert ("10:30,", "TIME") not in got and ("EU", "ACRONYM") in got and ("1 000", "NUMBER") in got and ("t.ex.", "ABBREVIATION") in got and ("x2", "MIXED") in got and ("4.", "ORDINAL") in got
    assert tokens.spoken_text("t.ex. 3 EU", sv) == "till exempel tre e u" and tokens.divide("a1..b") == ["a", "1", "..", "b"]


def loop_margin(rows, m):
    out = [list(r) for r in rows]
    for i, (s, e) in enumerate(rows):
        if (s - m > 0) if i == 0 else (s - rows[i - 1][1] > 2 * m):
            out[i][0] = s - m
        if i + 1 < len(rows) and rows[i + 1][0] - e > m:
            out[i][1] = e + m
    return [tuple(x) for x in out]


def test_margins_and_silences(spark):
    r = random.Random(1)
    rows, t = [], 30
    for _ in range(200):
        s = t + r.choice([0, 20, 60, 120, 400])
        t = s + r.randint(1, 500)
        rows.append((s, t))
    df = spark.createDataFrame([(1, s, e, "x") for s, e in rows], "k int, start_ms long, end_ms long, text string")
    got = sorted((x.start_ms, x.end_ms) for x in chunking.with_margin(df, ["k"], 50, "start_ms", "end_ms").collect())
    assert got == loop_margin(rows, 50)
    filled = chunking.with_silences(df, ["k"]).orderBy("start_ms", "end_ms").collect()
    assert all(a.end_ms == b.start_ms for a, b in zip(filled, filled[1:]))


def subs(*rows):
    return [{"start": s, "end": e, "text": t, "id": k, **x} for k, (s, e, t, *o) in enumerate(rows) for x in [o[0] if o else {}]]


def test_chunks():
    sil = chunking.SILENCE
    a = chunking.make_chunks(subs((0, 12_000, "a"), (12_000, 25_000, "b"), (25_000, 36_000, "c")))
    assert [(c["start"], c["end"], c["text"]) for c in a] == [(0, 25_000, "a b"), (25_000, 36_000, "c")] and a[1]["subs"][0]["start"] == 0
    b = chunking.make_chunks(subs((0, 20_000, "a"), (20_000, 95_000, sil), (95_000, 106_000, "b")), silent_chunks=True)
    assert [(c["start"], c["end"]) for c in b] == [(0, 30_000), (30_000, 60_000), (60_000, 90_000), (90_000, 106_000)]
    assert [c["text"] for c in chunking.make_chunks(subs((0, 20_000, "a"), (20_000, 95_000, sil), (95_000, 106_000, "b")))] == ["a", "b"]
    c = chunking.make_chunks(subs((0, 12_000, "a"), (12_000, 50_000, "long", {"is_long": True}), (50_000, 55_000, "short"), (55_000, 57_000, "live", {"live": True})))
    assert [x["text"] for x in c] == ["a"]
    assert chunking.make_chunks([]) == [] and a[0]["text_whisper"] == "<0.00> a<12.00><12.00> b<25.00>"
    assert all(x["duration"] <= 30_000 for x in b)


def test_sessions():
    assert chunking.capped_sessions([(0, 5), (6, 9), (30, 31), (32, 60)], 10, 20) == [0, 0, 1, 2]
    got = chunking.capped_sessions([(0, 5), (6, 9), (40, 41), (90, 95)], 10, 20)
    assert got == [0, 0, 1, 2]
    assert chunking.capped_sessions([], 1, 1) == []


def test_voice():
    assert voice.binarize([0.1, 0.9, 0.9, 0.1, 0.6, 0.1], 1.0, 0.5, 0.3) == [(1.0, 3.0), (4.0, 5.0)]
    long = voice.binarize([0.9] * 10 + [0.4] + [0.9] * 4 + [0.0], 1.0, 0.5, 0.3, max_duration=12)
    assert long[0][1] == 10.0 and long[1] == (10.0, 15.0)
    assert [g["end"] for g in voice.merged_groups([(0, 10), (11, 25), (26, 40)], 30)] == [25, 40] and voice.binarize([], 1.0) == []


def test_matching_in_order(spark):
    r = random.Random(5)
    ref = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    segments = [matching.Segment("f", k * 20.0, k * 20.0 + 18, [w if r.random() > 0.1 else "zzz" for w in ref[k * 20 : k * 20 + 20]]) for k in range(20)]
    found = matching.match_in_order(matching.Matcher(ref), segments)
    assert all(abs(p.first - k * 20) <= 2 and p.ratio > 0.7 for k, p in enumerate(found))
    joined = matching.joined_positions(found, most_s=100)
    assert joined[0].segment.end - joined[0].segment.start >= 100 and len(joined) < len(found)
    none = matching.match_in_order(matching.Matcher(ref), [matching.Segment("f", 0, 1, ["nothing"] * 20)])
    assert none[0].first == -1
    s = spark.createDataFrame([("k", p.segment.file, p.segment.start, p.segment.end, " ".join(p.segment.words)) for p in found[:5]], "k string, file string, start double, end double, text string")
    out = matching.matched(s, spark.createDataFrame([("k", " ".join(ref))], "k string, text string"), "k").orderBy("start").collect()
    assert len(out) == 5 and out[1].text.split()[5] == ref[25]


def test_words_and_times(spark):
    w = [("a", 0.0, 1.0), ("b", 1.0, 2.0), ("c", 3.0, 4.0)]
    df = spark.createDataFrame([(w,)], "w array<struct<word: string, start_time: double, end_time: double>>")
    got = df.select(*(words.index_at("w", F.lit(t)).alias(f"t{k}") for k, t in enumerate((-1.0, 0.0, 1.5, 2.5, 9.0))), words.text_between("w", F.lit(0.5), F.lit(2.5)).alias("x"), words.shifted("w", F.lit(10.0)).alias("s")).first()
    assert list(got)[:5] == [None, 0, 1, 2, 2] and got.x == "a b c" and got.s[0].start_time == 10.0
    b = df.select("w", F.lit(1).alias("i"), F.lit(3).alias("j")).select(words.time_bounds("w", "i", "j").alias("t")).first().t
    assert (b.start_time, b.end_time) == (1.0, 4.0)
    t = spark.range(1).select(times.srt_timestamp(F.lit(3661.5)).alias("a"), times.clock(F.lit(90061.0)).alias("b"), times.seconds_to_ms(F.lit(0.0125)).alias("c"), times.whisper_time(F.lit(1239)).alias("d"), times.ctc_length(F.lit(480_000)).alias("e"), times.ctc_length(F.lit(399)).alias("f")).first()
    assert tuple(t) == ("01:01:01,500", "01:01:01", 12, "<1.22>", 1499, 1)
    s = spark.range(1).select(times.softmax(F.array(F.lit(0.0), F.lit(0.0))).alias("p"), times.padded(F.array(F.lit(1.0)).cast("array<float>"), 3).alias("q"), times.pieces(F.array(*map(F.lit, range(5))), 2).alias("r")).first()
    assert s.p == [0.5, 0.5] and s.q == [1.0, 0.0, 0.0] and s.r == [[0, 1], [2, 3], [4]]
    v = spark.createDataFrame([([1.0] * 32_000, [2, 3])], "a array<float>, n array<int>").select(vectors.cut_audio("a", F.lit(500), F.lit(1000)).alias("c"), vectors.unflattened("a", "n").alias("u")).first()
    assert len(v.c) == 8000 and [len(x) for x in v.u] == [2, 3]


def test_cleaning(spark):
    c = lambda f, *t: spark.createDataFrame([t], ", ".join(f"c{i} string" for i in range(len(t)))).select(f(*(F.col(f"c{i}") for i in range(len(t)))).alias("x")).first().x
    assert c(cleaning.clean_protocol, "<p>STYLEREF x</p><p>Herr  talman!</p> (skratt) a &amp; b") == "Herr talman! a & b"
    assert c(cleaning.clean_chunk, "- Hej [x] <b> <1.20> *y* - -  slut- ... ... då") == "Hej <1.20> slut då"
    assert c(cleaning.piped_tags, "<1.20> a <12.00>") == "<|1.20|> a <|12.00|>"
    assert c(cleaning.clean_name, "Statsrådet ANNA-lena o'neil (S)") == "Anna-Lena O'Neil"
    assert c(cleaning.n_words, "") == 0 and c(cleaning.n_words, " a  b ") == 2 and c(cleaning.null_if_empty, "") is None
    assert c(cleaning.head_error, "", "") == 0 and c(cleaning.head_error, "abc", "abd") == pytest.approx(1 / 3) and c(cleaning.tail_error, "xxxxxxxxxxxxåbc", "åbc") == pytest.approx(0.7)
    assert c(cleaning.last_parts, "a/b/c.mp3") == "b/c.mp3" and c(cleaning.stem, "a/b/c.mp3") == "c" and c(cleaning.only_signs, "a - b ?") == ["-", "?"]


def test_keys(spark):
    df = spark.createDataFrame([(1, 1, None, "b"), (1, 2, 5, None), (1, 3, 6, "a"), (2, 1, None, None), (None, 1, 1, "x")], "k int, o int, v int, s string")
    got = {r.k: (r.v, r.s) for r in keys.first_values(df, ["k"], "o").collect()}
    assert got == {1: (5, "b"), 2: (None, None)}
    assert {r.k: r.o for r in keys.best_per_key(df.where("k IS NOT NULL"), ["k"], "v", "o").collect()} == {1: 3, 2: 1}
    assert {(r.k, r.o) for r in keys.drop_ambiguous(df.where("k IS NOT NULL"), ["k"], ["v"]).collect()} == {(1, 2), (1, 3), (2, 1)}
    m = spark.createDataFrame([({"a": 0.5, "b": 0.3, "sv": 0.1},), ({"sv": 0.9},)], "m map<string,double>")
    assert [r.t for r in m.select(keys.top_entries("m", 1, "sv").alias("t")).collect()] == [{"a": 0.5, "sv": 0.1}, {"sv": 0.9}]
    twice = spark.createDataFrame([(1, 2)], "a int, b int").select("a", "b", F.col("a").alias("b"))
    assert keys.unique_columns(twice).columns == ["a", "b"]
    lists = spark.createDataFrame([(1, 2, ["c"]), (1, 1, ["a", "b"]), (1, 3, None)], "k int, o int, l array<string>")
    assert lists.groupBy("k").agg(keys.ordered_lists("o", "l").alias("l")).first().l == ["a", "b", "c"]


def test_intervals_and_runs(spark):
    r = random.Random(2)
    a = [(i, r.randint(0, 3), s := r.randint(0, 5000), s + r.randint(0, 400)) for i in range(200)]
    b = [(i, r.randint(0, 3), s := r.randint(0, 5000), s + r.randint(0, 900)) for i in range(60)]
    x, y = spark.createDataFrame(a, "i int, k int, start_ms long, end_ms long"), spark.createDataFrame(b, "j int, k int, b_start_ms long, b_end_ms long")
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] == q[1] and min(p[3], q[3]) - max(p[2], q[2]) > 0)
    for bucket in (None, 100, 1000):
        assert sorted((z.i, z.j) for z in intervals.overlap_join(x, y, "k", bucket).collect()) == want
    u = intervals.union_intervals(x, ["k"], gap_ms=10).collect()
    cover = lambda rows: {(k, t) for k, s, e in rows for t in range(s, e)}
    assert cover((z.k, z.start_ms, z.end_ms) for z in u) >= cover((p[1], p[2], p[3]) for p in a)
    labels = spark.createDataFrame([(1, i, c, i, i + 1) for i, c in enumerate("aabbbac")], "k int, pos int, label string, start_ms int, end_ms int")
    assert [(z.label, z.start_ms, z.end_ms) for z in runs.label_runs(labels, ["k"], "label", ["pos"]).orderBy("run_id").collect()] == [("a", 0, 2), ("b", 2, 5), ("a", 5, 6), ("c", 6, 7)]
    nulls = spark.createDataFrame([(1, 0, None), (1, 1, None), (1, 2, "a")], "k int, pos int, label string")
    assert [z.run_id for z in runs.with_run_id(nulls, ["k"], "label", "pos").orderBy("pos").collect()] == [1, 1, 2]


def test_shards_and_upsert(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    total, want = 0, {}
    for i in range(1000):
        total += i % 7
        want[i] = total
    assert {r.id: r.s for r in shards.running_sum(df, ["id"], "v", "s").collect()} == want
    files = spark.createDataFrame([("x_0000.parquet",), ("x_0012.parquet",)], "f string")
    assert sorted(r.new_file for r in shards.renumbered(files, "f", files, "f").collect()) == ["x_0013.parquet", "x_0025.parquet"]
    old = spark.createDataFrame([([("t", "a"), ("u", "b")],), (None,)], "r array<struct<text: string, model: string>>")
    new = F.struct(F.lit("n").alias("text"), F.lit("a").alias("model"))
    assert [[x.text for x in r.y] for r in old.select(upsert.upserted("r", new, "model").alias("y")).collect()] == [["u", "n"], ["n"]]
    assert [len(r.y) for r in old.select(upsert.upserted("r", new).alias("y")).collect()] == [2, 1]
    maps = spark.createDataFrame([({"a": 1.0, "b": 2.0}, {"b": 3.0})], "o map<string,double>, n map<string,double>")
    assert maps.select(upsert.merged_map("o", "n").alias("m")).first().m == {"a": 1.0, "b": 3.0}
    flat = upsert.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string"), ["k"])
    assert sorted(map(tuple, flat.collect())) == [(1, "a"), (2, "c")]


def test_model_slot(spark):
    def load():
        def model(rows):
            if (rows["x"] == 3).any():
                raise ValueError("three")
            return rows.assign(y=rows["x"] * 2.0)[["x", "y"]]

        return model

    good, bad = slots.quarantined(slots.infer(spark.range(6).select(F.col("id").alias("x")).coalesce(1), load, "x long, y double", batch=4))
    assert sorted((r.x, r.y) for r in good.collect()) == [(i, 2.0 * i) for i in (0, 1, 2, 4, 5)] and [(r.x, r.error) for r in bad.collect()] == [(3, "ValueError: three")]


def test_locate_flow(spark):
    from datetime import date

    from talkweave.plans.locate import locate_speeches

    r = random.Random(9)
    say = lambda n: ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 8))) for _ in range(n)]
    recs, speeches = [], []
    for k in range(3):
        w = say(200)
        recs.append((f"r{k}", date(2000, 1, 1 + 10 * k), date(2000, 1, 2 + 10 * k), " ".join(w), [(x, float(i), i + 0.5) for i, x in enumerate(w)]))
        speeches.append((f"s{k}", date(2000, 1, 1 + 10 * k), " ".join(w[50:80])))
    a = spark.createDataFrame(speeches, "speech_id string, date date, text string")
    b = spark.createDataFrame(recs, "audio_path string, date_start date, date_end date, inference_text string, words array<struct<word: string, start_time: double, end_time: double>>")
    got = {x.speech_id: (x.audio_path, x.word_start, x.word_end, x.start_time, x.end_time) for x in locate_speeches(a, b).collect()}
    assert got == {f"s{k}": (f"r{k}", 50, 80, 50.0, 79.5) for k in range(3)}
    assert locate_speeches(a, b, widen_days=21, done=a.where("speech_id = 's0'")).count() == 2


def test_publish_flow(spark):
    from datetime import date

    from talkweave.plans.publish import publish

    rows = [("f", "s", date(2000, 1, 1), 0, 20_000, "hej du", "<0.00> hej du<1.00>", "hej du"), ("f", "s", date(2000, 1, 1), 20_000, 40_000, "", "", "")]
    got = publish(spark.createDataFrame(rows, "audio_file string, speech_id string, date date, start_ms long, end_ms long, text string, text_whisper string, transcription string")).orderBy("chunk_id").collect()
    assert got[1].previous_text == "hej du" and got[1].is_silence and got[0].wer == 0 and got[0].shard == "0000" and got[0].text_timestamps == "<|0.00|> hej du<|1.00|>"
