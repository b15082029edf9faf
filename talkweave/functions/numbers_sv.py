"""Swedish number words."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SMALL = "noll ett två tre fyra fem sex sju åtta nio tio elva tolv tretton fjorton femton sexton sjutton arton nitton".split()
_TENS = "  tjugo trettio fyrtio femtio sextio sjuttio åttio nittio".split(" ")
_ORDINAL = "nollte första andra tredje fjärde femte sjätte sjunde åttonde nionde tionde elfte tolfte trettonde fjortonde femtonde sextonde sjuttonde artonde nittonde".split()
_SCALES = ((10**12, "biljon", "biljoner"), (10**9, "miljard", "miljarder"), (10**6, "miljon", "miljoner"))


def cardinal(n: int) -> str:
    if n < 0:
        return "minus " + cardinal(-n)
    if n >= 10**15:
        return " ".join(_SMALL[int(d)] for d in str(n))
    for scale, one, many in _SCALES:
        if n >= scale:
            head, rest = divmod(n, scale)
            first = f"en {one}" if head == 1 else f"{cardinal(head)} {many}"
            return first + (f" {cardinal(rest)}" if rest else "")
    if n >= 1000:
        head, rest = divmod(n, 1000)
        return ("ettusen" if head == 1 else cardinal(head) + "tusen") + (cardinal(rest) if rest else "")
    if n >= 100:
        head, rest = divmod(n, 100)
        return ("etthundra" if head == 1 else _SMALL[head] + "hundra") + (cardinal(rest) if rest else "")
    if n >= 20:
        head, rest = divmod(n, 10)
        return _TENS[head] + (_SMALL[rest] if rest else "")
    return _SMALL[n]


def ordinal(n: int) -> str:
    if n < 0:
        return "minus " + ordinal(-n)
    if n < 20:
        return _ORDINAL[n]
    rest = n % 100
    if n < 100:
        return _TENS[n // 10] + _ORDINAL[n % 10] if n % 10 else _TENS[n // 10] + "nde"
    if rest:
        return cardinal(n - rest) + ordinal(rest)
    return cardinal(n) + ("de" if n % 1000 and not cardinal(n).endswith("n") else "de" if not cardinal(n).endswith("n") else "te")


@F.pandas_udf(StringType())
def cardinal_udf(numbers: pd.Series) -> pd.Series:
    """Number words; each distinct number is spelled once a batch."""
    return numbers.map({n: cardinal(int(n)) for n in numbers.dropna().unique()})
