import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave.functions import alignment as a


def brute(log_probs, tokens, blank=0):
    """Best path over all state sequences that collapse to the tokens."""
    n, k = log_probs.shape
    best = (-np.inf, None)
    for path in itertools.product(range(k), repeat=n):
        collapsed = [p for i, p in enumerate(path) if p != blank and (i == 0 or path[i - 1] != p)]
        if collapsed == tokens:
            best = max(best, (sum(log_probs[i, p] for i, p in enumerate(path)), path), key=lambda x: x[0])
    return best


def test_forced_alignment_is_the_best_path():
    rng = np.random.default_rng(0)
    for tokens in ([1], [1, 2], [1, 1], [2, 1, 2]):
        lp = np.log(rng.dirichlet(np.ones(3), 6))
        _, path = brute(lp, tokens)
        got = a.forced_alignment(lp, tokens)
        starts = [i for i, p in enumerate(path) if p and (i == 0 or path[i - 1] != p)]
        assert [g[0] for g in got] == starts
    assert a.forced_alignment(np.zeros((2, 3)), [1, 1]) == [] and a.forced_alignment(np.zeros((2, 3)), []) == []


def test_word_times():
    letters = {"-": 0, "|": 1, "a": 2, "b": 3}
    path = [0, 2, 2, 0, 3, 1, 1, 3, 0, 2]
    lp = np.full((10, 4), -5.0)
    lp[np.arange(10), path] = -0.1
    got = a.word_times(lp, ["ab", "ba", "x"], letters, 0.02, 10.0)
    assert [(w["start_time"], w["end_time"]) for w in got[:2]] == [pytest.approx((10.02, 10.10)), pytest.approx((10.14, 10.20))] and got[2]["start_time"] is None


def test_sentences(spark):
    t = "Herr talman! Det är bl.a. A. Svensson som sa 3. mars. Eller? \"Ja.\" och så  slutet"
    assert [t[s:e] for s, e in a.sentences(t, ("bl.a.",))] == ["Herr talman!", "Det är bl.a. A. Svensson som sa 3. mars.", "Eller?", '"Ja." och så  slutet']
    assert a.sentences("") == [] and a.sentences("  a ") == [(2, 3)]
    assert [x.text for x in spark.range(1).select(a.sentences_udf()(F.lit("Ett. Två.")).alias("s")).first().s] == ["Ett.", "Två."]


def test_features():
    t = np.arange(16_000) / 16_000
    low, high = (a.log_mel(np.sin(2 * np.pi * f * t)) for f in (300, 3000))
    assert low.shape == (80, 100) and low.mean(1).argmax() < high.mean(1).argmax()
    assert np.isfinite(a.log_mel(np.zeros(100))).all() and a.numeric_tokens({"a": 0, "b1": 1, "%": 2}) == [1, 2]


def test_segmentation_is_the_best_path():
    """Against all assignments of frames to tokens, with free frames before and behind."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        lp = np.log(rng.dirichlet(np.ones(4), 8))
        tokens = rng.integers(1, 4, 3).tolist()
        best = -np.inf
        for starts in itertools.combinations(range(8), 3):
            for end in range(starts[-1], 8):
                total = 0.0
                for k in range(starts[0], end + 1):
                    j = sum(s <= k for s in starts) - 1
                    total += lp[k, tokens[j]] if k in starts else max(lp[k, tokens[j]], lp[k, 0])
                best = max(best, total)
        got = a.ctc_segmentation(lp, [tokens[:1], tokens[1:]], 1.0, window=100)
        first = int(got[0]["start_time"])
        assert got[0]["end_time"] <= got[1]["start_time"] and first >= 0 and got[1]["end_time"] <= 8
        one = a.ctc_segmentation(lp, [tokens], 1.0, window=100)[0]
        # The confidence is the mean over the whole utterance, up to the pause behind it.
        assert one["confidence"] * (one["end_time"] - one["start_time"]) >= best - 1e-6
    assert a.ctc_segmentation(np.zeros((2, 4)), [[1, 2, 3]], 1.0)[0]["start_time"] is None and a.ctc_segmentation(np.zeros((2, 4)), [[], [1]], 1.0)[0]["confidence"] is None


def test_resampling_keeps_tones():
    from talkweave.sources.readers import decoded_wav, resampled

    t = np.arange(44_100) / 44_100
    got = resampled(np.sin(2 * np.pi * 440 * t), 44_100, 16_000)
    want = np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000)
    assert len(got) == 16_000 and np.abs(got[200:-200] - want[200:-200]).max() < 0.02
    assert np.abs(resampled(np.sin(2 * np.pi * 12_000 * t), 44_100, 16_000)[300:-300]).max() < 0.05  # above what 16 kHz holds
    import io
    import wave

    for width, top in ((1, 127), (2, 32767), (3, 2**23 - 1), (4, 2**31 - 1)):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(2)
            w.setsampwidth(width)
            w.setframerate(16_000)
            x = (np.array([0.0, 0.5, -0.5, 1.0]) * top).astype(int)
            raw = [int(v + 128).to_bytes(1, "little") if width == 1 else int(v).to_bytes(width, "little", signed=True) for v in x for _ in range(2)]
            w.writeframes(b"".join(raw))
        assert np.allclose(decoded_wav(out.getvalue())[1], [0, 0.5, -0.5, 1.0], atol=0.01)


def test_voice_limits():
    from talkweave.operators import voice

    scores = [0, 1, 1, 0, 0, 1, 0, 0, 0, 0, 1, 1, 1, 0]
    assert voice.binarize(scores, 1.0) == [(1, 3), (5, 6), (10, 13)]
    assert voice.binarize(scores, 1.0, min_duration_on=2) == [(1, 3), (10, 13)]
    assert voice.binarize(scores, 1.0, min_duration_off=2) == [(1, 6), (10, 13)]
    assert voice.binarize(scores, 1.0, pad_onset=1, pad_offset=1) == [(0, 7), (9, 14)]
