"""Classes of written tokens and their spoken forms."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F

from .lexicon import LEXICONS, Lexicon, sv

TYPES = ("WORD", "NUMBER", "ORDINAL", "TIME", "ABBREVIATION", "ACRONYM", "PUNCTUATION", "SYMBOL", "MIXED")
_PARTS = re.compile(r"[^\W\d_]+|\d+|\.+|.", re.DOTALL)


@dataclass
class Word:
    text: str
    start: int
    end: int
    type: str
    parts: list[str] = field(default_factory=list)


def divide(token: str) -> list[str]:
    """A token in stretches of letters, digits, dots, and single other signs."""
    return _PARTS.findall(token)


def divided(token):
    """Column: the same as `divide`, in the JVM (letters and digits of ASCII and Latin text)."""
    return F.regexp_extract_all(token, F.lit(r"(?s)(\p{L}+|[0-9]+|\.+|.)"), 1)


def is_time(token: str) -> bool:
    m = re.fullmatch(r"(\d{1,2})[:.](\d{2})", token)
    return bool(m) and int(m[1]) < 24 and int(m[2]) < 60


def classify(token: str, lex: Lexicon = sv) -> str:
    if token.lower() in lex.abbreviations:
        return "ABBREVIATION"
    if is_time(token):
        return "TIME"
    if re.fullmatch(r"\d+([.,]\d+)*", token):
        return "NUMBER"
    if re.fullmatch(r"\d+(\.|:[ae])", token):
        return "ORDINAL"
    if re.fullmatch(r"[^\W\d_]+", token):
        return "ACRONYM" if token.isupper() and 1 < len(token) <= 5 else "WORD"
    if not re.search(r"\w", token):
        return "SYMBOL" if token in lex.symbols else "PUNCTUATION"
    return "MIXED"


def words(text: str, lex: Lexicon = sv) -> list[Word]:
    """Tokens between blanks, their punctuation split off at both ends (but for abbreviations and ordinals), classified;
    neighbouring groups of three digits are one number."""
    out: list[Word] = []
    for m in re.finditer(r"\S+", text):
        token, at = m[0], m.start()
        if classify(token, lex) in ("ABBREVIATION", "ORDINAL", "TIME", "NUMBER", "SYMBOL"):
            pieces = [(token, at)]
        else:
            core = re.match(r"(\W*)(.*?)(\W*)$", token, re.DOTALL)
            pieces, here = [], at
            for x in core.groups():
                if x:
                    pieces.append((x, here))
                here += len(x)
        for x, here in pieces:
            kind = classify(x, lex)
            last = out[-1] if out else None
            if kind == "NUMBER" and re.fullmatch(r"\d{3}", x) and last and last.type == "NUMBER" and here == last.end + 1 and re.fullmatch(r"\d{1,3}( \d{3})*", last.text):
                last.text, last.end = f"{last.text} {x}", here + len(x)
                last.parts = divide(last.text)
            else:
                out.append(Word(x, here, here + len(x), kind, divide(x)))
    return out


def spoken(word: Word, lex: Lexicon = sv) -> str:
    """The word as it is read aloud, lower case; nothing for punctuation."""
    t = word.text.lower()
    if word.type == "ABBREVIATION":
        return lex.abbreviations[t]
    if word.type == "SYMBOL":
        return lex.symbols[t]
    if word.type == "TIME":
        h, m = re.split(r"[:.]", t)
        return f"{lex.cardinal(int(h))} {lex.cardinal(int(m))}".strip()
    if word.type == "ORDINAL":
        return lex.ordinal(int(re.match(r"\d+", t)[0]))
    if word.type == "NUMBER":
        whole, _, rest = t.replace(" ", "").partition(",")
        said = lex.cardinal(int(whole.replace(".", "")))
        return f"{said} {lex.comma} {lex.cardinal(int(re.sub(r'[.,]', '', rest)))}" if rest else said
    if word.type == "ACRONYM":
        return " ".join(t)
    if word.type == "PUNCTUATION":
        return ""
    return " ".join(lex.cardinal(int(p)) if p.isdigit() else p for p in word.parts if re.match(r"\w", p))


def spoken_text(text: str, lex: Lexicon = sv) -> str:
    return " ".join(s for w in words(text, lex) if (s := spoken(w, lex)))


def classified_udf(language: str = "sv"):
    """Arrow UDF: text -> array<struct<text, start, end, type, spoken>>."""

    @F.pandas_udf("array<struct<text: string, start: int, `end`: int, type: string, spoken: string>>")
    def udf(texts: pd.Series) -> pd.Series:
        lex = LEXICONS[language]
        return texts.map(lambda t: None if t is None else [{"text": w.text, "start": w.start, "end": w.end, "type": w.type, "spoken": spoken(w, lex)} for w in words(t, lex)])

    return udf
