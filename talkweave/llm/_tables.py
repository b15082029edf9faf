"""Reading the test tables, and tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType

from ..storage import dropped, shared_dir, stored

__all__ = ["BROADCAST_BYTES", "beside", "dropped", "fits", "fresh", "shared_dir", "stored", "table"]

#: A table is broadcast to a join with texts if it takes at most so many bytes, counted in full; larger ones are shuffled.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fits(kept: DataFrame) -> bool:
    """Whether a stored table has at most BROADCAST_BYTES. Every row counts with what it holds, arrays included."""
    size = F.lit(0).cast("long")
    for f in kept.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (ArrayType, MapType)):
            size = size + 24 + F.coalesce(F.size(c), F.lit(0)) * (16 + 8 * len(getattr(getattr(f.dataType, "elementType", None), "fields", "x")))
        elif f.dataType.typeName() in ("string", "binary"):
            size = size + 24 + F.coalesce(F.octet_length(c), F.lit(0))
        else:
            size = size + 16
    return (kept.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def beside(narrow: DataFrame) -> DataFrame:
    """A narrow table for a join with texts: stored, measured, and broadcast if it fits, so that the texts need no shuffle.
    Beyond that the join is left to Spark."""
    kept = stored(narrow)
    return F.broadcast(kept) if fits(kept) else kept


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df doesn't have, for columns that are added for a while."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
