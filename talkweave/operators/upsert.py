"""Updates of nested results by model, without leaving the JVM; resuming by what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upserted(results: str, new: Column, mode: str = "append") -> Column:
    """An array of structs with a field `model`, and a new one: "all" leaves the new one alone, "model" replaces its model's,
    "append" keeps what is there and adds the new one only if its model is missing."""
    old = F.coalesce(F.col(results), F.array().cast("array<struct<text: string, model: string>>"))
    if mode == "all":
        return F.array(new)
    others = F.filter(old, lambda x: x["model"] != new["model"])
    if mode == "model":
        return F.concat(others, F.array(new))
    return F.when(F.exists(old, lambda x: x["model"] == new["model"]), old).otherwise(F.concat(old, F.array(new)))


def merged_map(old: str, new: str) -> Column:
    """Both maps, the new one's values where both have a key."""
    kept = F.map_filter(F.coalesce(old, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))), lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, F.col(new))


def by_model(results: str, model: str, field: str = "text") -> Column:
    """A field of the last result of a model, null without one."""
    return F.try_element_at(F.filter(results, lambda x: x["model"] == model), F.lit(-1))[field]


def states(chunks: str, model: str) -> Column:
    """Of the first chunk: whether it is transcribed, by this model, and with word times."""
    first = F.try_element_at(F.col(chunks), F.lit(1))["transcription"]
    mine = F.filter(first, lambda x: x["model"] == model)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.struct(yes(F.size(first) > 0).alias("transcribed"), yes(F.size(mine) > 0).alias("by_model"), yes(F.exists(mine, lambda x: x["word_timestamps"].isNotNull())).alias("with_times"))


def spoken_chunks(chunks: str, fallback_all: bool = False) -> Column:
    """Number of chunks with text; with fallback_all all of them where none has any."""
    n = F.size(F.filter(chunks, lambda c: F.coalesce(c["text"], F.lit("")) != ""))
    return F.when((n == 0) & F.lit(fallback_all), F.size(chunks)).otherwise(n)


def upsert_table(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The flat form: new rows in place of old ones with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)
