"""Language packs for text normalisation: what is corrected, written out and spelled. `sv` is Swedish, `plain` is empty."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from . import numbers_sv


@dataclass(frozen=True)
class Lexicon:
    """corrections: regular expressions for scanning errors; abbreviations and symbols: literal; words for ranges and decimals."""

    cardinal: Callable[[int], str] = str
    ordinal: Callable[[int], str] = str
    corrections: dict[str, str] = field(default_factory=dict)
    abbreviations: dict[str, str] = field(default_factory=dict)
    symbols: dict[str, str] = field(default_factory=dict)
    until: str = "-"
    comma: str = ","
    chapter: str = ""
    paragraph: str = ""
    the_paragraph: str = ""


_SHORT = (
    ("bl.a.", "bland annat"), ("d.v.s.", "det vill säga"), ("dvs.", "det vill säga"), ("e.d.", "eller dylikt"), ("f.d.", "före detta"), ("f.n.", "för närvarande"), ("f.ö.", "för övrigt"),
    ("fr.o.m.", "från och med"), ("inkl.", "inklusive"), ("k.m:t", "kunglig majestät"), ("kungl. maj:t", "kunglig majestät"), ("m.a.o.", "med andra ord"), ("milj.kr.", "miljoner kronor"),
    ("m.m.", "med mera"), ("m.fl.", "med flera"), ("o.d.", "och dylikt"), ("o.dyl.", "och dylikt"), ("o.s.v.", "och så vidare"), ("osv.", "och så vidare"), ("p.g.a.", "på grund av"),
    ("s.a.s.", "så att säga"), ("s.k.", "så kallad"), ("t.o.m.", "till och med"), ("t.ex.", "till exempel"), ("t.v.", "tills vidare"), ("kungl.", "kungliga"),
)


def _spaced(short: str) -> tuple[str, str]:
    """Blanks that a scan put after the dots of an abbreviation, or a dot that it lost at the end."""
    parts = [p for p in short.rstrip(".").split(".") if p]
    return r"\b" + r"\.? ?".join(p.replace(" ", " ?") for p in parts) + r"\.(?!\w)", short


sv = Lexicon(
    numbers_sv.cardinal, numbers_sv.ordinal,
    corrections={r"\$": "§", **dict(_spaced(s) for s, _ in _SHORT if s.count(".") > 1 and " " not in s)},
    abbreviations=dict(_SHORT), symbols={"%": "procent", "½": "en halv"},
    until="till", comma="komma", chapter="kapitlet", paragraph="paragraf", the_paragraph="paragrafen",
)
plain = Lexicon()
LEXICONS = {"sv": sv, "plain": plain}
