"""Text cleaning with JVM regular expressions; NFKC alone needs Python."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Formulas that close a speech; each goes with the rest of its line.
CLOSINGS = (
    r"Överläggningen var (?:h|d)ärmed", r"\(Beslut fattades", r"Beslut skulle fattas", r"Kammaren beslutade", r"Detta beslut fattades", r"Partiställningarna var", r"Voteringen gav",
)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def replaced(c: Column, *rules: tuple[str, str]) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, *rule), rules, c)


def trimmed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_protocol(text: Column, normalise: bool = True) -> Column:
    """HTML and boilerplate out of a protocol's text: style references, tags, parentheses, closing formulas, white space."""
    c = replaced(text, (r"<p>[^<]*STYLEREF[^<]*</p>", ""), (r"<[^>]*>", " "), (r"\([^)]*\)", ""), *((f"{x}.*", "") for x in CLOSINGS))
    c = trimmed(nfkc(F.trim(c)) if normalise else F.trim(c))
    return F.regexp_replace(c, "&amp;", "&")


def without_headers(df: DataFrame, key: str, html: str, headers: DataFrame) -> DataFrame:
    """(key, text): the <p> paragraphs of each page that are no header, joined by blanks. headers: one column, header."""
    paragraphs = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"<p>(.*?)</p>"), 1)).alias("pos", "header"))
    kept = paragraphs.join(headers.select("header").distinct(), "header", "left_anti")
    return kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "header"))), lambda x: x["header"]), " ").alias("text"))


def clean_chunk(text: Column, normalise: bool = True) -> Column:
    """A chunk's text for publication: noise marks, brackets and stray dashes and dots out; numeric tags stay."""
    c = nfkc(text) if normalise else text
    c = replaced(
        c, (r"[-–] [-–]", " "), (r"/[^/]*/", " "), (r"\([^)]*\)", ""), (r"\[[^\]]*\]", ""), (r"<[A-Za-z]+>", ""), (r"\*[^*]*\*", ""), (r"^\s*[-–]+|[-–]+\s*$", ""),
        (r">\s*[-–]+", ">"), (r"[-–]+\s*<", "<"), (r">\s*\.\.\.", ">"), (r"(^|\s)[-–]+(?=[\p{L}\p{N}])", "$1"), (r"([\p{L}\p{N}])[-–]+(?=\s|$)", "$1"), (r"[-–]\.\.\.", "..."), (r"^\s*\.\.\.", ""), (r"\.\.\. \.\.\.", " "),
    )
    return trimmed(c)


def piped_tags(text: Column) -> Column:
    """<1.23> as <|1.23|>."""
    return F.regexp_replace(text, r"<(\d{1,2}\.\d{2})>", r"<|$1|>")


def clean_name(name: Column) -> Column:
    """A speaker's name without titles and parentheses, in title case (also after hyphens and apostrophes)."""
    c = trimmed(replaced(name, (r"\([^)]*\)", ""), (r"(?i)^(?:herr|fru|fröken|statsrådet|talmannen|\S*minister[n]?)\s+", "")))
    return F.array_join(F.transform(F.split(F.lower(c), r"(?<=[-' ])"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p)))), "")


def n_words(text: Column) -> Column:
    """Words between white space; 0 for an empty text."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def first_of_list(c: Column) -> Column:
    return F.substring_index(c, ", ", 1)


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def dates_in(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\d{4}-\d{2}-\d{2})"), 1)


def last_parts(path: Column, n: int = 2) -> Column:
    """The last n parts of a path."""
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), F.lit(n)), "/")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def only_signs(text: Column) -> Column:
    """Words without a letter or number."""
    return F.filter(F.split(text, r"\s+"), lambda w: (w != "") & ~w.rlike(r"[\p{L}\p{N}]"))


def head_error(a: Column, b: Column, n: int = 10) -> Column:
    """Character error of the first n characters: edit distance against the longer; 0 if both are empty."""
    return _error(F.substring(a, 1, n), F.substring(b, 1, n))


def tail_error(a: Column, b: Column, n: int = 10) -> Column:
    cut = lambda c: F.when(F.length(c) > n, F.substring(c, -n, n)).otherwise(c)
    return _error(cut(a), cut(b))


def _error(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / longest)
