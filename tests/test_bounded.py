"""Steps that go on in batches: the same rows as key by key or text by text, whatever the batches."""

import random
import time
import tracemalloc

import pyarrow as pa
import pytest

from talkweave.functions import alignment, normalise, similarity
from talkweave.functions.slices import slices
from talkweave.operators import chunking, matching
from talkweave.sources import readers, sinks


@pytest.fixture
def small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def timed_words(spark):
    """(rows by key in order, table): gaps and lengths of all kinds, words that are null, one key without any word."""
    rng, rows = random.Random(5), {}
    for k in (None, *range(12)):
        at, mine = 0, []
        for _ in range(rng.choice((1, 3, 40))):
            at += rng.choice((1, 3, 12, 40))
            mine.append((at, at + rng.choice((1, 5, 30)), None if k == 4 or rng.random() < 0.1 else f"w{at}"))
        rows[k] = mine
    flat = [(k, *x) for k, mine in rows.items() for x in mine]
    rng.shuffle(flat)
    return rows, spark.createDataFrame(flat, "k long, start_ms long, end_ms long, word string").repartition(3)


def folded(rows, numbers):
    """Rows of each number: key, number, least start, greatest end, text (null without a word)."""
    out = []
    for k, mine in rows.items():
        for n in sorted(set(of := numbers(mine))):
            part = [x for x, m in zip(mine, of) if m == n]
            said = [w for _, _, w in part if w is not None]
            out.append((k, n, min(s for s, _, _ in part), max(e for _, e, _ in part), " ".join(said) if said else None))
    return sorted(out, key=str)


def in_one_pass(df):
    """No call for each key: its transfer and its pandas table were what took the time."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan


def test_sessions_in_one_pass(spark, small_batches):
    rows, table = timed_words(spark)
    got = chunking.sessionised(table, "k", 10, 40)
    want = folded(rows, lambda mine: chunking.capped_sessions([x[:2] for x in mine], 10, 40))
    assert sorted(map(tuple, got.collect()), key=str) == want and in_one_pass(got)


def test_parts_in_one_pass(spark, small_batches):
    def numbers(mine):
        out, part, start = [], 0, None
        for s, e, _ in mine:
            start = s if start is None else start
            out.append(part)
            if e - start >= 25:
                part, start = part + 1, None
        return out

    rows, table = timed_words(spark)
    got = chunking.concatenated(table, "k", 25)
    assert sorted(map(tuple, got.collect()), key=str) == folded(rows, numbers) and in_one_pass(got)


def python_peak(function, texts):
    """Bytes of Python objects at most, while a batch goes through an Arrow UDF; and what it gives."""
    array = pa.array(texts, pa.string())
    tracemalloc.start()
    got = function(array)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak, got.to_pylist()


def test_sentences_a_slice_at_a_time(spark):
    texts = ["Ett bl.a. två. Tre! Fyra" * 20, None, "", "  ", "x" * 300] * 1500
    peak, got = python_peak(alignment.sentences_udf(("bl.a.",)).func, texts)
    one = [{"start": s, "end": e, "text": texts[0][s:e]} for s, e in alignment.sentences(texts[0], ("bl.a.",))]
    assert got[:5] == [one, None, [], [], [{"start": 0, "end": 300, "text": "x" * 300}]]
    assert got == got[:5] * 1500 and len(one) > 20
    assert peak < 16 << 20  # all sentences as dicts took more
    assert alignment.sentences_udf().func(pa.array([], pa.string())).to_pylist() == []


def test_slices():
    texts = pa.array(["a" * 5, None, "b" * 5, "c" * 50, "", "d"])
    assert [x.to_pylist() for x in slices(texts, 10)] == [["aaaaa", None, "bbbbb"], ["c" * 50], ["", "d"]]
    assert [len(x) for x in slices(texts.slice(2, 3), 4)] == [1, 1, 1] and [len(x) for x in slices(texts[:0])] == [0]


def test_sentences_of_a_long_text_in_one_pass():
    began = time.process_time()
    assert alignment.sentences("." * 200_000 + "x") == [(0, 200_001)]
    assert alignment.sentences("Ett. A " + "a. " * 100_000 + "b") == [(0, 4), (5, 300_008)]
    assert time.process_time() - began < 5


def test_a_file_for_each_document(spark, tmp_path):
    keys = ["a/b", "_x", ".y", "", "é" * 90, None, "none", *map(str, range(300))]
    docs = spark.createDataFrame([(k, [i]) for i, k in enumerate(keys)], "id string, n array<int>").repartition(5)
    for _ in range(2):  # a task that runs again writes the same files
        sinks.json_each(docs, f"file://{tmp_path}/d", "id")
    assert len([p for p in (tmp_path / "d").iterdir() if p.name[0] != "."]) == len(keys)
    got = readers.json_documents(spark, f"{tmp_path}/d", "id string, n array<int>")
    assert {(x.id, x.n[0]) for x in got.collect()} == {(k, i) for i, k in enumerate(keys)}
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file, but for the readers' limit
    try:
        assert readers.json_documents(spark, f"{tmp_path}/d", "id string").rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_normalised_texts_a_slice_at_a_time(spark):
    texts = ["Den 3 maj 1 000 kr. " * 100, None, "", "§ 5"] * 2500
    peak, got = python_peak(normalise.normalize_udf("sv").func, texts)
    assert got == [normalise.normalize_text(t) for t in texts[:4]] * 2500
    assert peak < 8 << 20  # all texts and results as Python strings took more


def test_gram_hits(spark, small_batches):
    rng = random.Random(2)
    said = lambda n: "".join(rng.choice("aabc") + rng.choice((" ", "\t", "\n", " \x0b", "  ")) for _ in range(n))
    texts, passages = [(i, said(rng.choice((0, 3, 5, 60)))) for i in range(60)] + [(60, None)], [(i, said(7)) for i in range(9)] + [(9, "a b")]
    want = {}
    for i, t in texts:
        w = (t or "").encode().split()
        for item, p in passages:
            q = p.encode().split()
            at = [k for k in range(len(w) - 4) if w[k : k + 5] in [q[x : x + 5] for x in range(len(q) - 4)]]
            if at:
                want[i, item] = (len(at), at[0])
    got = matching.gram_hits(spark.createDataFrame(texts, "id long, text string"), "id", "text", passages, "item", "long")
    assert {(x.id, x.item): (x.hits, x.first) for x in got.collect()} == want and len(want) > 20
    assert matching.gram_hits(spark.createDataFrame(texts, "id long, text string"), "id", "text", [], "item", "long").count() == 0


def test_windows_are_bounded_by_their_neighbours(monkeypatch):
    """The same window as by all, with few of them compared."""
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    needle = letters(200)
    text = letters(2000) + needle[:60] + letters(40) + needle[100:] + letters(2000)
    compared, lcs = [], similarity._lcs_length
    monkeypatch.setattr(similarity, "_lcs_length", lambda masks, size, b: compared.append(1) or lcs(masks, size, b))
    score, s, e = similarity.partial_alignment(text, needle)
    calls = len(compared)
    assert score == max(similarity.ratio(needle, text[i : i + 200]) for i in range(len(text) - 199)) == similarity.ratio(needle, text[s:e])
    assert calls < 200
