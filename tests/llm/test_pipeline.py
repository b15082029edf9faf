"""The pipeline's stages on odd rows, and its whole result against one made without Spark's operators."""

from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline as pipeline
from talkweave.llm import fertility, packing, secret_scan
from talkweave.llm._arrays import flat
from talkweave.llm._tables import table

from .test_operators import brute_groups, brute_spans


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_columns_and_take_odd_rows(k, spark, docs, clashing, empty, sf_dir):
    name, stage = pipeline.STAGES[k]
    assert stage(spark, docs, sf_dir).columns == docs.columns
    got = stage(spark, clashing, sf_dir)
    assert got.columns == clashing.columns and got.count() <= clashing.count()
    assert stage(spark, empty, sf_dir).count() == 0
    assert got.where("doc_id IS NULL").count() == 2  # rows without an id stay


def test_pack_stage(spark, clashing, empty, sf_dir):
    stage = pipeline.STAGES[-1][1]
    assert stage(spark, clashing, sf_dir).count() > 0 and stage(spark, empty, sf_dir).count() == 0


def test_run_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    bad = {r.doc_id for r in fertility.rules(docs, table(spark, sf_dir, "labels")).where("reject").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is None or r.doc_id not in bad]
    gone = brute_groups({i: t for i, t in rows if i is not None and t})
    by_id = {i: t for i, t in rows if i is not None and i not in gone}
    loose = [t for i, t in rows if i is None]
    cut: dict[int, list] = {}
    for i, a, b, _ in brute_spans(by_id, 50):
        cut.setdefault(i, []).append((a, b))
    words = Counter()
    models = secret_scan.train()
    for i, t in [*by_id.items(), *((None, t) for t in loose)]:
        w = (t or "").split()
        for a, b in reversed(cut.get(i, [])):
            w = w[:a] + w[b:]
        text = " ".join(w)
        data, offsets = flat(pa.array([text]))
        raw = data.tobytes()
        for a, b, _ in sorted(zip(*secret_scan.spans(data, offsets, models)), reverse=True):
            raw = raw[:a] + secret_scan.MASK.encode() + raw[b:]
        text = raw.decode()
        words[i] += len(text.split())
    got = Counter()
    windows = Counter()
    for r in pipeline.run(spark, sf_dir).collect():
        got[r.doc_id] += r.n_words
        windows[r.window_id] += r.n_words
    assert got == +words and max(windows.values()) <= packing.CAPACITY
