"""Places for model inference: a callable that turns a batch of rows into rows, run by mapInPandas.

No model comes with the library. A bad item yields an error text in place of a result, so that one file never fails a job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Model = Callable[[pd.DataFrame], pd.DataFrame]


def infer(df: DataFrame, load: Callable[[], Model], schema: str, batch: int = 16) -> DataFrame:
    """Rows of `schema` plus error (null where all went well). `load` runs once a task; batches that fail are tried again row by
    row, and rows that fail alone are returned with nulls and the error's text."""
    names = [f.split()[0].strip("`") for f in _fields(schema)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for part in parts:
            for k in range(0, len(part), batch):
                rows = part.iloc[k : k + batch]
                try:
                    yield model(rows).assign(error=None)[[*names, "error"]]
                except Exception:  # noqa: BLE001
                    for i in range(len(rows)):
                        one = rows.iloc[i : i + 1]
                        try:
                            yield model(one).assign(error=None)[[*names, "error"]]
                        except Exception as e:  # noqa: BLE001
                            yield pd.DataFrame({n: [one[n].iloc[0] if n in one else None] for n in names} | {"error": [f"{type(e).__name__}: {e}"]})

    return df.mapInPandas(run, f"{schema}, error string")


def _fields(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[at:i].strip())
            at = i + 1
    return [*out, schema[at:].strip()]


def quarantined(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and bad ones with it."""
    return df.where(F.col("error").isNull()).drop("error"), df.where(F.col("error").isNotNull())


def language_probabilities(logits: str, languages: list[str]):
    """Column: map of language to probability from an array of logits in the same order."""
    from ..functions.times import softmax

    return F.map_from_arrays(F.array(*(F.lit(x) for x in languages)), softmax(F.col(logits)))


def regrouped(df: DataFrame, key: str, order: str, apply: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """apply to all rows of each key, in order, in one pass over batches of any size: a key whose rows lie in several batches is
    held until its last one has come. Keys share a task's batches instead of having one call each with its own transfer."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            last = held[key].iloc[-1] if len(held) else None
            whole = held[key].ne(last) & ~(held[key].isna() & pd.isna(last))
            for _, g in held[whole].groupby(key, sort=False, dropna=False):
                yield apply(g)
            held = held[~whole]
        if held is not None:
            for _, g in held.groupby(key, sort=False, dropna=False):
                yield apply(g)

    return df.repartition(key).sortWithinPartitions(key, order).mapInPandas(run, schema)
