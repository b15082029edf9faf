"""Each operator against brute force, a round trip or held-out accuracy, and on odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from talkweave.llm import _bpe, additive, bpe, fertility, huffman, packing, recompression, secret_scan, setsketch, suffix_dedup, toxicity
from talkweave.llm._arrays import flat
from talkweave.llm._components import components
from talkweave.llm._suffixes import common_prefixes, previous_factors, suffix_order
from talkweave.llm._tables import table

from .conftest import prose

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=_bpe.load_ranks(bpe.VOCABULARY), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return _bpe.Encoder(_bpe.load(bpe.VOCABULARY))


def test_bpe_equals_exact_merging(encoder, reference):
    r = random.Random(1)
    letters = list("ab cdst'lrevem' \n\t ü1 2.,!é中 　😀'\x00  AB%%")
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(4000)]
    texts += ["", "'", "''s", " 's", "a's'll", "x'LL 're", "a" * 3000, "  " * 500, "!" * 1000, "é" * 50]
    ids, first = encoder.encode(*flat(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == reference.encode_ordinary(t), t
    data, at = encoder.decode(ids, first)
    assert [data[at[i] : at[i + 1]].tobytes().decode() for i in range(len(texts))] == texts


def test_bpe_forgets_words_and_stays_right(reference, monkeypatch):
    monkeypatch.setattr(_bpe, "REMEMBERED", 8)
    e = _bpe.Encoder(_bpe.load(bpe.VOCABULARY))
    for seed in range(5):
        t = prose(seed, 200)
        assert e.encode(*flat(pa.array([t])))[0].tolist() == reference.encode_ordinary(t)


def test_bpe_rows_and_round_trip(spark, docs, clashing, empty, rows, reference):
    for source in (docs, clashing):
        got = bpe.encode(source)
        assert sorted((r.doc_id or -1, r.ids) for r in got.collect()) == sorted((i or -1, reference.encode_ordinary(t or "")) for i, t, *_ in rows)
        assert got.where("NOT exact").count() == 0
    back = bpe.decode(bpe.encode(docs))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t or "") for i, t, *_ in rows)
    assert bpe.encode(empty).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).collect()[0].text is None


def test_huffman_is_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(0)
    for _ in range(10):
        n = int(rng.integers(2, 400))
        counts = np.zeros(500, np.int64)
        counts[rng.choice(500, n, replace=False)] = rng.integers(1, 1000, n)
        of = np.flatnonzero(counts)
        heap = [(int(counts[s]), k, [k]) for k, s in enumerate(of)]
        depth = np.zeros(n, int)
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            depth[a[2] + b[2]] += 1
            heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
        assert (huffman.code_lengths(counts, 40)[of] * counts[of]).sum() == (depth * counts[of]).sum()
        short = huffman.code_lengths(counts, 9)
        assert short.max() <= 9 and (2.0 ** -short[of].astype(float)).sum() == pytest.approx(1)
    assert huffman.code_lengths(np.array([0, 5, 0])).tolist() == [0, 1, 0] and not huffman.code_lengths(np.zeros(4, int)).any()


def test_huffman_round_trip(docs, clashing, empty, rows, reference):
    coded, lengths = huffman.encode_ids(clashing)
    assert coded.where("NOT exact").count() == 0
    back = huffman.decode_ids(coded, lengths)
    assert Counter((r.doc_id, tuple(r.ids)) for r in back.collect()) == Counter((i, tuple(reference.encode_ordinary(t or ""))) for i, t, *_ in rows)
    for r in coded.collect():
        assert len(r.checkpoints) == -(-r.n_tokens // huffman.BLOCK) and len(r.payload) == -(-r.n_bits // 8)
    counts = Counter(x for _, t, *_ in rows for x in reference.encode_ordinary(t or ""))
    assert sum(r.n_bits for r in coded.collect()) == sum(n * int(lengths[i]) for i, n in counts.items())
    assert huffman.encode_ids(empty)[0].count() == 0


def test_fertility_measures(docs, rows, reference):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=fertility.PIECES)
    got = fertility.measures(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t, *_ in rows:
        if i is None or len(t or "") > 100_000:
            continue
        ids, r = reference.encode_ordinary(t or ""), by_id[i]
        assert r.n_tokens == len(ids)
        if not ids:
            assert r.chars_per_token is None and r.entropy is None
            continue
        p = np.array(list(Counter(ids).values())) / len(ids)
        assert r.chars_per_token == pytest.approx(len(t) / len(ids), abs=1e-5) and r.entropy == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-5)
        own = sp.encode(t)
        lost = sum(sp.is_byte(k) and sp.id_to_piece(k) not in ("<0x09>", "<0x0A>") for k in own)
        assert r.byte_share == pytest.approx(lost / len(own), abs=1e-5)


def test_fertility_keeps_good_and_rejects_junk(spark, empty):
    r = random.Random(4)
    good = [(i, prose(i, r.randint(150, 200)), "en") for i in range(400)]
    junk = [(1000 + i, " ".join(w.upper() + r.choice(["%%%", "###", "&&&", "$$$"]) for w in prose(i, 150).split()), "en") for i in range(40)] + [(2000, "spam " * 200, "en"), (2001, "", "en"), (2002, None, None)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 400, 2)], "doc_id long, quality int")
    bad = {x.doc_id for x in fertility.rules(docs, labels).where("reject").collect()}
    assert {x for x in bad if x >= 1000} == {x[0] for x in junk} and sum(x < 1000 for x in bad) <= 12
    assert fertility.rules(empty, labels).count() == 0
    assert {x.doc_id for x in fertility.rules(docs, labels.limit(0)).where("reject").collect()} <= {2000, 2001, 2002}  # no labels: outer limits only


def brute_groups(texts, threshold=setsketch.THRESHOLD):
    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}

    sets = {i: grams(t) for i, t in texts.items() if t.split()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets if find(i) != i}


def test_near_duplicates(docs, clashing, empty, texts):
    want = brute_groups(texts)
    assert want[20] == 3 and want[21] == 5
    for source in (docs, clashing):
        assert {r.doc_id: r.kept_doc_id for r in setsketch.near_duplicates(source).collect()} == want
    assert setsketch.near_duplicates(empty).count() == 0


def test_near_duplicates_many(spark):
    """A large group of copies, unlike texts that share a passage, and random edits."""
    r = random.Random(2)
    texts, shared = {}, prose(5000, 60)
    for i in range(300):
        w = prose(9000, 200).split()
        for _ in range(8):
            w[r.randrange(200)] = f"w{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    for i in range(300, 420):
        texts[i] = shared + " " + prose(i, 90)
    for i in range(420, 700):
        texts[i] = prose(i, 120)
        w = texts[i].split()
        for _ in range(r.randint(0, 20)):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts[i + 1000] = " ".join(w)
    want = brute_groups(texts)
    got = {x.doc_id: x.kept_doc_id for x in setsketch.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert set(got) <= set(want) and len(set(got) & set(want)) >= 0.97 * len(want)
    assert all(got.get(i) == 0 for i in range(1, 300))


def test_near_duplicates_through_a_middle_original(spark):
    """Copies with 8 % of their words changed: each resembles the original, but hardly another copy."""
    r = random.Random(8)
    texts = {}
    for g, k in enumerate((200, 20, 20)):
        for i in range(k):
            w = prose(7000 + g, 250).split()
            for at in r.sample(range(250), 20 if i != k // 2 else 0):
                w[at] = f"y{r.randrange(10**6)}"
            texts[g * 1000 + i] = " ".join(w)
    want = brute_groups(texts)
    assert len(want) >= 235
    got = {x.doc_id: x.kept_doc_id for x in setsketch.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == want


def test_resembling_rows_of_two_leaders():
    """Rows 5 and 6 resemble each other, but are connected through rows 0 and 1 before they could lead."""
    rng = np.random.default_rng(0)
    r = rng.integers(3000, 3400, (7, setsketch._M)).astype(np.uint16)
    r[5, :114], r[6, 34:114], r[1, 34:84], r[1, 114:] = r[0, :114], r[0, 34:114], r[0, 34:84], r[6, 114:]
    r[0, 34:54] = rng.integers(3000, 3400, 20)
    r[1, :34] = r[6, :34]
    a, b, *_ = setsketch.resembling(np.zeros(7, np.int64), r, 0.37, 0.63)
    assert {(0, 5), (1, 6), (5, 6)} <= {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())}


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        n = int(2000 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], rng.integers(0, 2**63, 2000 - n, dtype=np.uint64)])
        r = setsketch.registers(np.concatenate([a, b, a, b]), np.array([0, 2000, 4000, 8000]))
        assert np.array_equal(np.maximum(r[0], r[1]), r[2])
        assert setsketch.jaccard(r[:1], r[1:2])[0] == pytest.approx(share, abs=0.14)
        assert setsketch.cardinality(r[:1])[0] == pytest.approx(2000, rel=0.3)


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 7)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(texts, length):
    seen, out = {}, []
    for i in sorted(texts):
        w = texts[i].split()
        hits = []
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            if g in seen:
                hits.append((k, seen[g]))
            else:
                seen[g] = i
        for k, source in hits:
            if out and out[-1][0] == i and k <= out[-1][2]:
                out[-1][2] = k + length
            else:
                out.append([i, k, k + length, source])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("operator", [recompression.repeated_passages, suffix_dedup.later_copies])
def test_repeats(operator, spark, docs, clashing, empty, texts):
    want = brute_spans(texts, 50)
    assert {x[0] for x in want} >= {20, 23, 28}
    for source in (docs, clashing):
        assert sorted(tuple(r) for r in operator(source).select("doc_id", "start_word", "end_word", "source_doc_id").collect()) == want
    assert operator(empty).count() == 0


@pytest.mark.parametrize("operator", [recompression.repeated_passages, suffix_dedup.later_copies])
def test_planted_repeats(operator, spark):
    """Passages of 50 words and more in random texts, some in many documents, some overlapping, with ties and periods."""
    r = random.Random(7)
    passages = [prose(3000 + k, 50 + k) for k in range(30)]
    texts = {}
    for i in range(150):
        parts = [prose(i * 10 + k, r.randint(5, 60)) for k in range(3)]
        texts[i] = " ".join([parts[0], passages[r.randrange(30)], parts[1], passages[r.randrange(30)] if i % 2 else "", parts[2]])
    texts[200] = "one two three " * 60
    texts[201] = prose(1, 20) + " " + "one two three " * 40
    texts[202] = "one " * 49
    got = sorted(tuple(x) for x in operator(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).select("doc_id", "start_word", "end_word", "source_doc_id").collect())
    assert got == brute_spans(texts, 50)


def test_suffixes_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(40):
        parts = [rng.integers(0, rng.integers(1, 5), rng.integers(1, 50)) for _ in range(rng.integers(1, 6))]
        t, size = np.concatenate(parts).astype(np.uint64), np.array([len(p) for p in parts])
        ends = np.repeat(np.cumsum(size), size)
        suffix = [tuple(t[i : ends[i]].tolist()) for i in range(len(t))]
        order, levels = suffix_order(t, ends, 100)
        assert [suffix[i] for i in order] == sorted(suffix)

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        factors = previous_factors(order, common_prefixes(order, levels, ends))
        assert all(factors[i] == max((common(suffix[i], suffix[j]) for j in range(i)), default=0) for i in range(len(t)))
        for length in (2, 4):
            a, b = suffix_dedup.earlier_factors(t, ends, length), recompression.shared_windows(t, ends, length)
            assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_packing_windows(docs, clashing, empty, rows):
    got = packing.pack(clashing, capacity=100, group=16).collect()
    fill, covered = defaultdict(int), Counter()
    for r in got:
        assert r.offset == fill[r.window_id]
        fill[r.window_id] += r.n_words
        for k in range(r.start_word, r.start_word + r.n_words):
            covered[r.doc_id, k] += 1
    assert max(fill.values()) <= 100
    want = Counter((i, k) for i, t, *_ in rows for k in range(len((t or "").split())))
    assert covered == want
    assert packing.pack(empty).count() == 0


def test_differencing_balances():
    rng = np.random.default_rng(0)
    for n, k in ((1, 1), (3, 5), (50, 7), (400, 31)):
        sizes = rng.integers(1, 100, n)
        sums = np.bincount(packing.differencing(sizes, k), sizes, minlength=k)
        assert sums.sum() == sizes.sum() and (n < 4 * k or sums.max() - sums.min() <= 3)
    assert np.bincount(packing.pack_group(np.full(10, 60), 100), np.full(10, 60)).max() == 60
    assert np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4]).max() == 16  # the textbook case


def test_secret_models_on_held_out_samples():
    m = secret_scan.train()
    secrets, names = secret_scan.random_strings(3000, 77), secret_scan.identifiers(3000, 78)
    found = lambda texts: np.mean([len(secret_scan.spans(*flat(pa.array([t])), m)[0]) > 0 for t in texts])
    assert found(secrets) > 0.99 and found(names) < 0.002


def test_secrets(docs, clashing, empty, texts):
    m = secret_scan.train()
    for source in (docs, clashing):
        got = secret_scan.find_secrets(source, m).collect()
        assert [texts[r.doc_id][r.start_char : r.end_char] for r in got] == ["9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"]
    masked = {r.doc_id: r for r in secret_scan.masked(docs, m).collect()}
    assert secret_scan.MASK in masked[29].text and masked[29].n_chars == len(masked[29].text) and masked[1].text == texts[1]
    assert secret_scan.masked(clashing, m).columns == clashing.columns and secret_scan.masked(docs, m).count() == docs.count()
    assert secret_scan.find_secrets(empty, m).count() == 0 and secret_scan.masked(empty, m).count() == 0


def test_secrets_glued_to_words():
    """Inside URLs, paths and prefixed names; several in one run."""
    m, r = secret_scan.train(), random.Random(6)
    key = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    hexa, base62 = "0123456789abcdef", secret_scan._ALPHABET[:62]
    lost = n = 0
    for before in ("https://example.com/", "https://hooks.example.com/services/incoming/messages/", "/srv/deploy/production/settings/", "my_service_access_token_"):
        for letters, size in ((hexa, 40), (hexa, 32), (base62, 24), (base62, 40)):
            for _ in range(25):
                k = key(letters, size)
                text = before + k + r.choice(["", "/messages/latest"])
                starts, ends, _ = secret_scan.spans(*flat(pa.array([text])), m)
                n, lost = n + 1, lost + (not any(a <= text.index(k) and text.index(k) + size <= b for a, b in zip(starts, ends)))
    assert lost <= 0.03 * n, (lost, n)
    two = f"configuration/settings/{key(hexa, 40)}/production-environment-variables-and-other-names/{key(base62, 40)}"
    starts, ends, _ = secret_scan.spans(*flat(pa.array([two])), m)
    assert len(starts) == 2 and all(size in two.split("/") for size in (two[a:b] for a, b in zip(starts, ends)))
    names = pa.array([w for w in secret_scan.identifiers(5000, 79)])
    assert len(secret_scan.spans(*flat(names), m)[0]) <= 5


def test_secret_places_count_characters(spark):
    t = 'é中😀 key "A1b2C3d4E5f6G7h8I9j0K1l2M3" and k9X2mQ7vR4tZ8pL3wN6yB1cD5 ünd plainwordthatisverylongindeed 12345678901234567890'
    got = secret_scan.find_secrets(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()
    assert sorted(t[r.start_char : r.end_char] for r in got) == ["A1b2C3d4E5f6G7h8I9j0K1l2M3", "k9X2mQ7vR4tZ8pL3wN6yB1cD5"]


def test_toxicity_held_out(spark):
    r = random.Random(5)
    bad = {"en": ["vilefoo", "awfulbar", "nastybaz"], "fr": ["mochefoo", "laidbar"]}
    made = []
    for i in range(900):
        lang, w = r.choice(["en", "fr"]), prose(i, r.randint(5, 120)).split()
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad[lang]) + r.choice(["", "s,", "er."]))
        made.append((i, " ".join(w), lang, toxic))
    docs = spark.createDataFrame([m[:3] for m in made], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(m[0], m[3]) for m in made if m[0] < 600], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {x.doc_id: x.toxic for x in toxicity.classify(docs, model).collect()}
    held = [m for m in made if m[0] >= 600]
    assert np.mean([got[m[0]] == bool(m[3]) for m in held]) > 0.97
    assert toxicity.train(docs, labels, most=10).threshold > 0


def test_toxicity_odd_rows(spark, docs, clashing, empty):
    none = toxicity.fit([], np.zeros(0), [])
    assert toxicity.classify(docs, none).where("toxic").count() == 0 and toxicity.classify(empty, none).count() == 0
    texts = [prose(i, 20) + (" vile" if i % 2 else "") for i in range(80)]
    model = toxicity.fit(texts, np.array([i % 2 for i in range(80)], float), ["en"] * 80)
    got = toxicity.classify(clashing, model)
    assert got.count() == docs.count() and got.where("doc_id IN (25, 26, 31) AND (toxic OR probability > 0)").count() == 0


def test_pooling_ignores_borders():
    m = toxicity.fit(["a b c", "d e f"] * 10, np.array([0, 1] * 10, float), ["en"] * 20)
    one = [toxicity.probability(m, *flat(pa.array([t])))[0] for t in ("a", "d e", "b c a d e f", "")]
    assert np.allclose(toxicity.probability(m, *flat(pa.array(["a", "d e", "b c a d e f", ""]))), one, atol=1e-6)


def exact_neighbours(ids, x, k):
    d = ((x[:, None, :] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return {int(ids[i]): set(ids[np.lexsort((ids, d[i]))[:k]].tolist()) for i in range(len(ids))}


@pytest.mark.parametrize("clusters", [0, 12])
def test_neighbours_recall(spark, clusters, monkeypatch):
    """Blocks far smaller than in production, so that several cells are searched."""
    monkeypatch.setattr(additive, "BLOCK", 150)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    if clusters:
        x = x * 0.2 + rng.normal(size=(clusters, 16)).astype(np.float32)[rng.integers(0, clusters, 700)] * 3
    ids = rng.permutation(700) + 5
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)]
    got = defaultdict(set)
    for r in additive.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 10, 60).collect():
        got[r.vec_id].add(r.neighbour_id)
    want = exact_neighbours(ids, x, 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len(got[i] & want[i]) / 10 for i in want]) >= 0.95


def test_neighbours_in_tight_clusters():
    """Near copies that the codes can't tell apart, and more equal vectors than are reranked, at production parameters."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5500, 32)).astype(np.float32)
    x[:2000] = x[0] + rng.normal(size=(2000, 32)).astype(np.float32) * 1e-3
    x[2000:2500] = x[2000]
    ids = rng.permutation(5500)
    books = additive.first_books(x, np.random.default_rng(1))
    codes = additive.encode(books, x)
    near = additive.decoded(books, codes)
    error = np.sqrt(((x - near) ** 2).sum(1))
    some = np.array([*range(0, 2000, 40), *range(2000, 2500, 50), *range(2500, 5500, 100)])
    at, i, d = additive.nearest(books, x[some], ids[some], x, ids, codes, (near**2).sum(1), error, additive.NEIGHBOURS, additive.RERANK)
    for j, own in enumerate(some):
        exact = ((x.astype(float) - x[own].astype(float)) ** 2).sum(1)
        exact[own] = np.inf
        assert i[at == j].tolist() == ids[np.lexsort((ids, exact))[: additive.NEIGHBOURS]].tolist()


def test_neighbours_odd_rows(spark):
    rows = [(i, [float(i), 0.0], 1) for i in range(6)] + [(6, None, 1), (7, [], 1), (8, [1.0], 1), (9, [float("nan"), 1.0], 1), (10, [None, 1.0], 1), (None, [1.0, 1.0], 1), (2, [2.0, 0.0], 1), (11, [1.0, 0.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int")
    got = additive.neighbours(v, 3, 10).orderBy("vec_id", "rank").collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3, 4, 5, 11}
    assert [(r.neighbour_id, r.distance) for r in got if r.vec_id == 0] == [(1, 1.0), (11, 1.0), (2, 2.0)]
    assert [r.neighbour_id for r in got if r.vec_id == 11][0] == 1
    assert additive.neighbours(v.limit(0)).count() == 0
    assert additive.neighbours(v.where("vec_id < 2"), 3).count() == 2


def test_beam_search_beats_greedy():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 16)).astype(np.float32)
    books = additive.first_books(x, rng)[:4]
    error = [((x - additive.decoded(books, additive.encode(books, x, beam))) ** 2).sum() for beam in (1, 6)]
    assert error[1] < error[0]
    codes = additive.encode(books, x)
    q = x[:3]
    table_score = (additive.decoded(books, codes) ** 2).sum(1) - 2 * sum((books[b] @ q.T)[codes[:, b]] for b in range(len(books))).T
    exact = ((additive.decoded(books, codes)[None] - q[:, None]) ** 2).sum(2) - (q**2).sum(1)[:, None]
    assert np.allclose(table_score, exact, atol=1e-2)


def test_queries_cover_whole_tables(spark, sf_dir):
    from talkweave.llm.queries import QUERIES

    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for name, more in (("op2_bpe", 0), ("op7_huffman", 1), ("op8_fertility", 0)):  # op7 has a header
        assert QUERIES[name](spark, sf_dir).count() == len(rows) + more
    assert QUERIES["op4_packing"](spark, sf_dir).select(F.sum("n_words")).first()[0] == sum(len((t or "").split()) for _, t in rows)
    texts = {i: t for i, t in rows if i is not None and t}
    assert {r.doc_id: r.kept_doc_id for r in QUERIES["op9_setsketch"](spark, sf_dir).collect()} == brute_groups(texts)
    m, found = secret_scan.train(), Counter()
    for i, t in rows:
        data, offsets = flat(pa.array([t or ""]))
        for a, b in zip(*secret_scan.spans(data, offsets, m)[:2]):
            found[i, data[a:b].tobytes().decode()] += 1
    by_id = dict(rows)
    assert Counter((r.doc_id, by_id[r.doc_id][r.start_char : r.end_char]) for r in QUERIES["op5_secrets"](spark, sf_dir).collect()) == found
    # Every document is classified, and only those of a probability at or above a threshold come out.
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    every = {(r.doc_id, r.probability) for r in toxicity.classify(docs, model).where("toxic").collect()}
    assert {(r.doc_id, r.probability) for r in QUERIES["op6_toxicity"](spark, sf_dir).collect()} == every and toxicity.classify(docs, model).count() == len(rows)
    vectors = [(i, [float(i % 7), float(i * i % 11), float(i)]) for i in range(101)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.mode("overwrite").parquet(f"{sf_dir}/embeddings.parquet")
    got = defaultdict(set)
    for r in QUERIES["op1_additive"](spark, sf_dir).collect():
        got[r.vec_id].add(r.neighbour_id)
    want = exact_neighbours(np.arange(101), np.array([v for _, v in vectors]), 10)
    assert got == {i: want[i] for i in range(0, 101, 20)}


def test_bpe_of_long_words(encoder, reference):
    """Words of thousands of letters without a blank, random and repetitive."""
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefghij") for _ in range(n)) for n in (255, 256, 257, 3000)] + ["ab" * 2000, "的一是" * 900, "x" + "!" * 700 + "the" * 400]
    ids, first = encoder.encode(*flat(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == reference.encode_ordinary(t)
