"""Operator 5: secrets, told from ordinary identifiers by two character Markov models."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._arrays import flat, slices
from ._tables import table

#: Public words for the ordinary identifiers that the second model learns from.
WORDS = "/opt/tokenizers/word_bpe_49k.json"
#: Labelled samples of either kind that are made for training, and lengths that are told apart (longer ones count as this).
SAMPLES, LENGTHS = 20_000, 128
#: Log-likelihood ratio that a secret has at least, and that ordinary words inside one have to have against it to part it.
SURE = 5.0
MASK = "[SECRET]"
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_CODE = np.full(256, -1, np.int16)
_CODE[np.frombuffer(_ALPHABET.encode(), np.uint8)] = np.arange(len(_ALPHABET))
_START = len(_ALPHABET)
_GLUE = np.zeros(256, bool)
_GLUE[np.frombuffer(b"+/_-", np.uint8)] = True


#: Alphabets of random strings, each with a model of its own, and the lengths that are made of it.
_BASE62 = _ALPHABET[:62]
KINDS = [
    ("0123456789abcdef", ((16, 65), (32, 41))), ("0123456789ABCDEF", ((16, 65),)), (_BASE62, ((12, 65), (16, 41))), (_BASE62 + "+/", ((16, 90),)), (_BASE62 + "_-", ((16, 65),)),
    (_BASE62[26:62], ((16, 41),)), (_BASE62[:26] + _BASE62[52:62], ((16, 41),)), (_BASE62[:52], ((20, 41),)), (_BASE62[:26], ((24, 41),)), (_BASE62[26:52], ((24, 41),)),
]
#: Published formats of well-known services: alphabet (of KINDS), prefix, length.
FORMATS = [
    (5, "AKIA", 16), (5, "ASIA", 16), (2, "ghp_", 36), (2, "gho_", 36), (2, "sk_live_", 24), (4, "AIza", 35), (4, "glpat-", 20), (2, "npm_", 36), (7, "hf_", 34), (4, "eyJ", 60),
]


def random_strings(n: int, seed: int, kinds: list[int] | None = None) -> list[str]:
    """Labelled samples of secrets: random strings in the usual alphabets and lengths (12 to 90), also of letters alone, some
    with a short prefix, and keys in the published formats of well-known services. kinds: gets the alphabet of each."""
    rng = np.random.default_rng(seed)
    prefixes = ["", "", "", "", "key_", "sk-", "tok_", "id-"]
    out = []
    for _ in range(n):
        if rng.random() < 0.25:
            kind, prefix, size = FORMATS[rng.integers(len(FORMATS))]
            letters = KINDS[kind][0]
        else:
            kind = int(rng.integers(len(KINDS)))
            letters, sizes = KINDS[kind]
            prefix, size = prefixes[rng.integers(len(prefixes))], rng.integers(*sizes[rng.integers(len(sizes))])
        out.append(prefix + "".join(letters[i] for i in rng.integers(0, len(letters), size)))
        if kinds is not None:
            kinds.append(kind)
    return out


def identifiers(n: int, seed: int, path: str = WORDS) -> list[str]:
    """Labelled samples of what is no secret: words, numbers, dates, units and short codes of up to eight characters; and long
    ones: compounds of public words in the usual styles, paths, long numbers and ruled lines. Half are of either kind."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    stems = sorted({w.removesuffix("</w>") for w in vocabulary if 2 <= len(w.removesuffix("</w>")) <= 12})
    stems = [w for w in stems if w.isascii() and w.isalpha()]
    rng = np.random.default_rng(seed)
    base36 = _ALPHABET[26:62]
    out = []
    while len(out) < n:
        style = rng.integers(0, 20)
        some = [stems[i] for i in rng.integers(0, len(stems), rng.integers(3, 9))]
        digits = "".join(map(str, rng.integers(0, 10, rng.integers(20, 40))))
        if style == 0:
            w = "_".join(some)
        elif style == 1:
            w = "-".join(some)
        elif style == 2:
            w = "/".join(some)
        elif style == 3:
            w = some[0] + "".join(s.title() for s in some[1:])
        elif style == 4:
            w = "_".join(some).upper()
        elif style == 5:
            w = "-".join(some[:-1]) + f"{rng.integers(0, 10_000)}"
        elif style == 6:
            w = digits if rng.random() < 0.5 else "-".join(digits[k : k + 4] for k in range(0, len(digits), 4))
        elif style == 7:
            w = "_-/+ax0"[rng.integers(7)] * int(rng.integers(20, 60)) if rng.random() < 0.3 else f"{some[0]}/{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}/" + "_".join(some[1:])
        elif style == 8:
            w = "".join(some).upper()
        elif style == 9:
            w = "".join(some)
        elif style < 14:
            w = (some[0], some[0].title(), some[0].upper(), some[0] + some[1])[style - 10]
        elif style == 14:
            w = digits[: rng.integers(1, 17)]
        elif style == 15:
            w = f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}" if rng.random() < 0.5 else f"{rng.integers(1, 29)}/{rng.integers(1, 13)}/{rng.integers(1900, 2100)}"
        elif style == 16:
            w = some[0] + digits[: rng.integers(1, 5)] if rng.random() < 0.5 else digits[: rng.integers(1, 5)] + some[0][:3]
        elif style == 17:
            w = "".join(base36[i] for i in rng.integers(0, 36, rng.integers(2, 9)))
        elif style == 18:
            w = f"{some[0]}-{some[1]}" if rng.random() < 0.5 else f"{some[0]}/{some[1]}"
        else:
            w = some[0][:4].upper() + "-" + digits[: rng.integers(2, 7)]
        out.append(w)
    return out


@dataclass
class Models:
    """ratio: for each of KINDS, log-likelihood ratio of each character given the one before, random against ordinary.
    length: that of each length (the last entry for all longer ones). prior: of each kind. Thresholds: of a part of a run with
    its length, and of a whole run."""

    ratio: np.ndarray
    length: np.ndarray
    prior: float
    threshold: float
    part: float


def _transitions(samples: list[str]) -> np.ndarray:
    n = len(_ALPHABET)
    counts = np.full((n + 1, n), 0.2)
    for s in samples:
        c = _CODE[np.frombuffer(s.encode(), np.uint8)].astype(np.int64)
        np.add.at(counts, (np.concatenate([[_START], c[:-1]]), c), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def _each(ratio: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each byte given the one before."""
    code = _CODE[data].astype(np.int64)
    before = np.concatenate([[_START], code[:-1]])
    return np.where(code >= 0, ratio[np.where(before >= 0, before, _START), np.maximum(code, 0)], 0.0)


def best_part(each: np.ndarray) -> tuple[int, int, float]:
    """Start, end and total of the contiguous part of largest total."""
    total = np.concatenate([[0.0], np.cumsum(each)])
    gain = total - np.minimum.accumulate(total)
    end = int(gain.argmax())
    return int(total[: end + 1].argmin()), end, float(gain[end])


def parts(each: np.ndarray, least: float, apart: float = SURE) -> list[tuple[int, int, float]]:
    """All parts that score `least`: the best, then the best of what lies before it and behind it, and so on. A part that
    holds ordinary words as surely as `apart` is taken apart there."""
    todo, out = [(0, len(each))], []
    while todo:
        a, b = todo.pop()
        i, j, s = best_part(each[a:b])
        if s >= least and j > i:
            k, m, drop = best_part(-each[a + i : a + j])
            if drop >= apart:
                todo += [(a, a + i + k), (a + i + m, b)]
            else:
                out.append((a + i, a + j, s))
                todo += [(a, a + i), (a + j, b)]
    return sorted(out)


def _lengths(samples: list[str]) -> np.ndarray:
    """Log probability of each length up to LENGTHS, the sample's smoothed over neighbouring lengths and all of them."""
    counts = np.bincount(np.minimum([len(x) for x in samples], LENGTHS), minlength=LENGTHS + 1).astype(float)
    wide = np.convolve(counts, np.ones(5) / 5, "same")
    wide = (wide + 0.05) / (wide + 0.05).sum()
    return np.log(wide)


def train(path: str = WORDS, samples: int = SAMPLES, seed: int = 5) -> Models:
    """The models from labelled samples; the thresholds from samples that were held out: what only one identifier in 10,000
    reaches, but at least SURE (the random model must be e^5 times likelier)."""
    kinds: list[int] = []
    secrets, names = random_strings(samples, seed, kinds), identifiers(samples, seed + 1, path)
    ordinary = _transitions(names)
    ratio = np.stack([_transitions([x for x, kind in zip(secrets, kinds) if kind == k]) - ordinary for k in range(len(KINDS))])
    length = _lengths(secrets) - _lengths(names)
    first = Models(ratio, length, -float(np.log(len(KINDS))), SURE, SURE)
    held = [w.encode() for w in identifiers(samples, seed + 2, path)]
    data = np.frombuffer(b" ".join(held), np.uint8)
    # Only runs that could reach SURE are scored: the quantile lies above it, or SURE is the threshold.
    could = [max_scores(data[a:b], first) for a, b in zip(*candidates(data, np.array([0, len(data)]), first))]
    high = lambda x: max([SURE, *sorted(x)[-1 - samples // 10_000 :][:1]])
    whole, best = zip(*could) if could else ((), ())
    return Models(ratio, length, first.prior, high(whole), high(best))


def max_scores(data: np.ndarray, models: Models) -> tuple[float, float]:
    """The score of a run as a whole, and that of its best part."""
    size = float(models.length[min(len(data), LENGTHS)])
    whole, best = -np.inf, -np.inf
    for r in models.ratio:
        each = _each(r, data)
        whole = max(whole, float(each.sum()) + size + models.prior)
        best = max([best, *(s for _, _, s in scored_parts(data, each, models))])
    return whole, best


def scored_parts(data: np.ndarray, each: np.ndarray, models: Models) -> list[tuple[int, int, float]]:
    """Start, end and score of the likeliest parts of one run. A part goes on to the next of / _ - + on either side, so that
    no rest of a secret stays, and its length counts as it is then."""
    cuts = np.flatnonzero(_GLUE[data])
    own: list[list] = []
    for i, j, s in parts(each, max(models.part - models.prior - float(models.length.max()), 0.5)):
        k, m = np.searchsorted(cuts, i), np.searchsorted(cuts, j)
        i, j = int(cuts[k - 1]) + 1 if k else 0, int(cuts[m]) if m < len(cuts) else len(data)
        if own and i < own[-1][1]:
            own[-1][1:] = [max(j, own[-1][1]), max(s, own[-1][2])]
        else:
            own.append([i, j, s])
    return [(i, j, s + models.prior + float(models.length[min(j - i, LENGTHS)])) for i, j, s in own]


def in_run(data: np.ndarray, models: Models) -> list[tuple[int, int, float]]:
    """Start, end and score of the secrets in one run of the alphabet's characters: the parts that are sure enough by any
    kind's model (where kinds overlap, by the surer), or, where there is none, the whole run."""
    found: list[tuple[int, int, float]] = []
    whole = -np.inf
    for r in models.ratio:
        each = _each(r, data)
        whole = max(whole, float(each.sum()) + models.prior + float(models.length[min(len(data), LENGTHS)]))
        found += [x for x in scored_parts(data, each, models) if x[2] >= models.part]
    if not found:
        return [(0, len(data), whole)] if whole >= models.threshold else []
    out: list[tuple[int, int, float]] = []
    for x in sorted(found, key=lambda x: (-x[2], x[0])):
        if all(x[1] <= y[0] or y[1] <= x[0] for y in out):
            out.append(x)
    return sorted(out)


def candidates(data: np.ndarray, offsets: np.ndarray, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of the runs of the alphabet's characters that could reach a threshold.

    A run has no part that is longer than it is: the best length ratio up to its length, and the largest ratios of its
    characters by any kind's model, bound every score in it; first all of these that are positive, then those of the best
    contiguous part.
    """
    n = len(data)
    inside = _CODE[data] >= 0
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    most = models.ratio.max(0)
    each = _each(most, data)
    # The first character of a text follows none, whatever lies before it.
    head = starts[np.isin(starts, offsets)]
    each[head] = most[_START, np.maximum(_CODE[data[head]], 0)]
    best_length = np.maximum.accumulate(models.length)[np.minimum(ends - starts, LENGTHS)] + models.prior
    goal = min(models.part, models.threshold) - 1e-6
    rising = np.concatenate([[0.0], np.cumsum(np.maximum(each, 0))])
    may = rising[ends] - rising[starts] + best_length >= goal
    starts, ends, best_length = starts[may], ends[may], best_length[may]
    may = _best_sums(each, starts, ends) + best_length >= goal
    return starts[may], ends[may]


def spans(data: np.ndarray, offsets: np.ndarray, models: Models) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte, and score, of every secret: parts of runs of the alphabet's characters whose log-likelihood ratio,
    with that of their length, is large enough, whatever they are glued to. Every run of every length is considered; nothing
    but the models decides."""
    found = [(a + i, a + j, s) for a, b in zip(*(x.tolist() for x in candidates(data, offsets, models))) for i, j, s in in_run(data[a:b], models)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at, to, s = zip(*found)
    return np.array(at), np.array(to), np.array(s)


def _best_sums(each: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The largest total of a contiguous part of each span, spans of like length at once; very long spans are taken as passed."""
    size, out = ends - starts, np.full(len(starts), np.inf)
    low = 0
    for high in (16, 32, 64, 128, 256):
        of = np.flatnonzero((size > low) & (size <= high))
        low = high
        for some in np.split(of, range(20_000, len(of), 20_000)):
            at = starts[some, None] + np.arange(high)
            values = np.where(at < ends[some, None], each[np.minimum(at, len(each) - 1)], 0.0)
            total = np.concatenate([np.zeros((len(some), 1)), np.cumsum(values, axis=1)], axis=1)
            out[some] = (total - np.minimum.accumulate(total, axis=1)).max(1)
    return out


def find_secrets(docs: DataFrame, models: Models | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, start_char, end_char, n_chars, score): every secret in every text, end exclusive.

    Texts are scanned whole, and every run of letters, digits and + / _ - in them, however short: the character models and
    the lengths of either kind decide by their joint likelihood ratio. An empty or null text has none; rows are scanned one
    by one, so repeated rows, also with different texts, are reported as often as they come and a null id is passed on; an
    empty table gives an empty result; further columns don't matter.
    The models, two small tables, are trained on the driver from labelled samples of bounded number and sent along.
    """
    kind = dict(docs.dtypes)[key]
    shipped = docs.sparkSession.sparkContext.broadcast(models or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                starts, ends, s = spans(data, offsets, shipped.value)
                row = np.searchsorted(offsets, starts, "right") - 1
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                begin = chars[starts] - chars[offsets[row]]
                size = ends - starts  # all of one byte
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(begin), pa.array(begin + size), pa.array(size), pa.array(np.round(s, 4))], ["doc_id", "start_char", "end_char", "n_chars", "score"]
                )

    return docs.select(docs[key].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, start_char long, end_char long, n_chars long, score double")


def masked(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """docs with every secret in `text` replaced by MASK; n_chars, where there is one, follows. No row goes.

    Rows are masked one by one: null ids, repeated rows and further columns stay as they are; null and empty texts too; a
    very long text is scanned whole; an empty table stays empty.
    """
    schema, columns = docs.schema, docs.columns
    shipped = docs.sparkSession.sparkContext.broadcast(models or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part.column("text"))
                starts, ends, _ = spans(data, offsets, shipped.value)
                if len(starts):
                    row = np.searchsorted(offsets, starts, "right") - 1
                    k = part.schema.get_field_index("text")
                    texts = part.column(k).to_pylist()
                    sizes = part.column("n_chars").to_pylist() if "n_chars" in columns else None
                    for r in np.unique(row).tolist():
                        raw, at, out = data[offsets[r] : offsets[r + 1]].tobytes(), 0, []
                        for j in np.flatnonzero(row == r).tolist():
                            out += [raw[at : starts[j] - offsets[r]], MASK.encode()]
                            at = int(ends[j] - offsets[r])
                        texts[r] = b"".join([*out, raw[at:]]).decode()
                        if sizes:
                            sizes[r] = len(texts[r])
                    part = part.set_column(k, part.schema.field(k), pa.array(texts, part.schema.field(k).type))
                    if sizes:
                        k = part.schema.get_field_index("n_chars")
                        part = part.set_column(k, part.schema.field(k), pa.array(sizes, part.schema.field(k).type))
                yield part

    return docs.mapInArrow(run, schema)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`find_secrets` over the documents table."""
    return find_secrets(table(spark, sf_dir, "documents"))


def mask_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with their secrets masked; odd rows as in `masked`."""
    return masked(docs)
