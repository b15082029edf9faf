"""Text normalisation for matching, plain and with the provenance of every span."""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .lexicon import LEXICONS, Lexicon, sv
from .slices import by_slices

_PUNCTUATION = re.escape(string.punctuation)
Rule = tuple[str, "str | Callable[[re.Match], str]", str]


def _number_rules(lex: Lexicon) -> list[tuple[str, Callable[[re.Match], str] | str]]:
    say = lambda x: lex.cardinal(int(x))
    rules: list[tuple[str, Callable[[re.Match], str] | str]] = []
    if lex.chapter:
        rules.append((r"(\d+) kap\. (\d+) §", lambda m: f"{lex.ordinal(int(m[1]))} {lex.chapter} {lex.ordinal(int(m[2]))} {lex.the_paragraph}"))
    return rules + [
        (r"(\d+):(\d+)", lambda m: f"{say(m[1])} {say(m[2])}"),
        (r"(\d+)-(\d+)", lambda m: f"{say(m[1])} {lex.until} {say(m[2])}"),
        (r"(\d+),(\d+)", lambda m: f"{say(m[1])} {lex.comma} {say(m[2])}"),
    ]


def normalize_text(text: str | None, lex: Lexicon = sv) -> str | None:
    """Lower case, words for abbreviations, symbols and numbers, no punctuation, single blanks.

    Groups of digits are joined in one pass from the left, so "1 000 000" is read as 1000 and 000.
    """
    if text is None:
        return None
    t = text.lower()
    for short, long in (lex.abbreviations | lex.symbols).items():
        t = t.replace(short, long)
    rules = _number_rules(lex)
    if lex.chapter:
        t = re.sub(*rules.pop(0), t)
    t = re.sub(r"(\d+)[. ](\d{3})(?!\d)", r"\1\2", t)
    for pattern, replacement in rules:
        t = re.sub(pattern, replacement, t)
    t = re.sub(r"(?<=\d)[,:/-](?=\d)", " ", t)
    if lex.paragraph:
        t = re.sub(r"(?<=\d )§", lex.the_paragraph, t)
        t = re.sub(r"§(?= \d)", lex.paragraph, t)
    t = unicodedata.normalize("NFKC", t)
    t = re.sub(f"[{_PUNCTUATION}]", "", t)
    t = re.sub(r"\s+", " ", re.sub(r"\W+", " ", t)).strip()
    return re.sub(r"\d+", lambda m: lex.cardinal(int(m[0])), t)


@dataclass
class Span:
    """What became of a stretch of the text."""

    original_start: int
    original_end: int
    kind: str
    replacement: str
    normalized_start: int = 0
    normalized_end: int = 0
    original_token: str = ""
    index: int = 0


def span_rules(lex: Lexicon) -> list[Rule]:
    """Rules in the order in which they claim characters."""
    rules: list[Rule] = [(re.escape(a), b, "substitution") for a, b in lex.abbreviations.items()]
    rules += [(re.escape(a), f" {b} ", "substitution") for a, b in lex.symbols.items()]
    numbers = _number_rules(lex)
    if lex.chapter:
        rules.append((*numbers.pop(0), "substitution"))
    rules.append((r"\d+[. ]\d{3}(?!\d)", lambda m: lex.cardinal(int(re.sub(r"\D", "", m[0]))), "substitution"))
    rules.append((r"\([^)]*\)", "", "deletion"))
    rules += [(p, r, "substitution") for p, r in numbers]
    if lex.paragraph:
        rules += [(r"(?<=\d )§", lex.the_paragraph, "substitution"), (r"§(?= \d)", lex.paragraph, "substitution")]
    return rules + [
        (f" [{_PUNCTUATION}] ", " ", "substitution"), (f"[{_PUNCTUATION}]", "", "deletion"), (r"\s{2,}", " ", "substitution"), (r"^\s+|\s+$", "", "deletion"),
        (r"\d+", lambda m: lex.cardinal(int(m[0])), "substitution"), (r"\w+", lambda m: m[0], "substitution"),
    ]


def normalize_with_spans(text: str, lex: Lexicon = sv, user_rules: Sequence[Rule] = ()) -> tuple[str, list[Span], str]:
    """(normalised text, spans in order, corrected text): every replaced, deleted or kept word with its place on both sides.

    Earlier rules claim their characters first; a match that touches a claimed character is passed over. user_rules come
    last. NFKC is applied before matching, so that places agree.
    """
    text = unicodedata.normalize("NFKC", text)
    for pattern, right in lex.corrections.items():
        text = re.sub(pattern, lambda m, right=right: right, text, flags=re.IGNORECASE)
    low = text.lower()
    if len(low) != len(text):  # a few letters grow in lower case
        text = low
    claimed = bytearray(len(low))
    spans: list[Span] = []
    for pattern, replacement, kind in [*span_rules(lex), *user_rules]:
        for m in re.finditer(pattern, low):
            if m.end() > m.start() and not any(claimed[m.start() : m.end()]):
                claimed[m.start() : m.end()] = b"\x01" * (m.end() - m.start())
                spans.append(Span(m.start(), m.end(), kind, replacement(m) if callable(replacement) else replacement))
    spans.sort(key=lambda s: s.original_start)
    out, at, length = [], 0, 0
    for i, s in enumerate(spans):
        out += [low[at : s.original_start], s.replacement]
        length += s.original_start - at
        s.normalized_start, s.normalized_end, s.index = length, length + len(s.replacement), i
        s.original_token = text[s.original_start : s.original_end]
        length += len(s.replacement)
        at = s.original_end
    return "".join(out) + low[at:], spans, text


def normalized_tokens(spans: list[Span], casing: Callable[[str], str] = str.upper) -> list[dict]:
    """One record a word of the normalised text, pointing to its span; several words of one span are marked."""
    out = []
    for s in spans:
        words = s.replacement.split()
        if s.kind != "substitution" or not words:
            continue
        for k, w in enumerate(words):
            out.append({"token": casing(w), "normalized_word_index": s.index, "is_multi_word": len(words) > 1, "is_first_word": k == 0, "is_last_word": k == len(words) - 1})
    return out


SPAN_TYPE = "array<struct<original_start int, original_end int, kind string, replacement string, normalized_start int, normalized_end int, original_token string, index int>>".replace(" int", ": int").replace(" string", ": string")


def normalize_udf(language: str = "sv"):
    """Arrow UDF: text -> normalised text. Python holds a slice of texts at a time."""

    @F.arrow_udf("string")
    def udf(texts: pa.Array) -> pa.Array:
        lex = LEXICONS[language]
        return by_slices(texts, lambda part: pa.array([normalize_text(t, lex) for t in part], pa.string()))

    return udf


def spans_udf(language: str = "sv"):
    """Arrow UDF: text -> array of spans (null for null)."""

    @F.pandas_udf(SPAN_TYPE)
    def udf(texts: pd.Series) -> pd.Series:
        lex = LEXICONS[language]
        return texts.map(lambda t: None if t is None else [vars(s) for s in normalize_with_spans(t, lex)[1]])

    return udf
