"""Time and interval scalars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts: str) -> Column:
    """Milliseconds since 1970 of a timestamp as written, whatever the session's zone."""
    return (F.unix_date(F.to_date(ts)) * F.lit(86_400_000).cast("long") + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000 + F.floor(F.expr(f"extract(SECOND FROM `{ts}`)") * 1000)).cast("long")


def srt_timestamp(seconds: Column) -> Column:
    """hh:mm:ss,mmm, cut off after the milliseconds."""
    ms = F.floor(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def clock(seconds: Column) -> Column:
    """HH:MM:SS, starting afresh after 24 hours."""
    s = F.floor(seconds).cast("long") % 86_400
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def seconds_to_ms(seconds: Column) -> Column:
    """Half to even, as Python rounds."""
    return F.bround(seconds * 1000).cast("long")


def whisper_time(ms: Column) -> Column:
    """<s.ss>, cut off to 20 ms."""
    return F.format_string("<%.2f>", F.floor(ms / 20) * 20 / 1000.0)


def frames(ms: Column, rate: int = 16_000) -> Column:
    return F.floor(ms * rate / 1000).cast("long")


def ctc_length(samples: Column, chunk_s: int = 30, rate: int = 16_000) -> Column:
    """Logits of an acoustic model of 400 + 320 n samples: full chunks, then the rest."""
    one = (chunk_s * rate - 80) // 320
    rest = samples % (chunk_s * rate)
    return (F.floor(samples / (chunk_s * rate)) * one + F.when(rest == 0, 0).when(rest < 400, 1).otherwise(F.floor((rest - 80) / 320))).cast("long")


def logit_time(logit: Column, frames_: Column, logits: Column, start_s: Column, rate: int = 16_000) -> Column:
    """Time of a logit within a recording."""
    return logit * F.try_divide(frames_, logits) / rate + start_s


def held(value: Column, use) -> Column:
    """use(value), with value computed once a row although a lambda function needs it for every element."""
    return F.transform(F.array(value), use)[0]


def softmax(scores: Column) -> Column:
    powers = held(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp(x - top)))
    total = held(powers, lambda p: F.struct(p.alias("p"), F.aggregate(p, F.lit(0.0), lambda a, b: a + b).alias("t")))
    return held(total, lambda h: F.transform(h["p"], lambda x: x / h["t"]))


def offset_seconds(offsets: Column, samples_a_logit: int = 320, rate: int = 16_000) -> Column:
    """Word offsets in logits (word, start_offset, end_offset) as times of two decimals."""
    at = lambda c: F.round(c * samples_a_logit / rate, 2)
    return F.transform(offsets, lambda w: F.struct(w["word"].alias("word"), at(w["start_offset"]).alias("start_time"), at(w["end_offset"]).alias("end_time")))


def padded(values: Column, length: int, fill: float = 0.0) -> Column:
    """An array cut or filled up to a length."""
    return F.slice(F.concat(values, F.array_repeat(F.lit(fill).cast("float"), length)), 1, length)


def pieces(values: Column, length: int) -> Column:
    """An array in pieces of a length; the last may be shorter."""
    n = F.size(values)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / length).cast("int")), lambda i: F.slice(values, i * length + 1, F.lit(length)))).otherwise(F.array())
