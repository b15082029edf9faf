"""Operator 8: quality rules from the fertility of public tokenisers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import _bpe
from ._arrays import flat, hash_spans, slices, words
from ._tables import beside, fits, stored, table
from .bpe import VOCABULARY, encoder, ship

#: A vocabulary of pieces with byte fallback, beside the byte-level one that is used for encoding.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Share of labelled good documents that may lie beyond an edge of a band: below for characters a token, word characters a
#: token and entropy (junk has little of them), above for the share of byte fallback.
TAILS = {"chars_per_token": 0.001, "word_chars": 0.001, "entropy": 0.001, "byte_share": 0.0001}
#: How far an edge is then moved out, as a factor: quantiles this far out are drawn from few documents. With n of them the
#: factor grows by n^-WIDER: bands of well-known sizes are narrow, a single document sets no edge at all.
SLACK, WIDER = {"chars_per_token": 0.02, "word_chars": 0.05, "entropy": 0.02, "byte_share": 0.2}, 0.75
#: Share of byte fallback, and number of its tokens, that are let pass in any text (a few odd characters).
LEAST_BYTES, FEW_BYTES = 0.02, 8
#: Bands are drawn for each language, and for each script, by size (whole part of log2 n_tokens): up to 2^40 tokens.
LARGEST = 40
#: Limits that hold for any text, also where no band is known, the more exactly the more tokens n there are: least
#: characters a token less 1/n (Latin letters; others), most and 100/n, least spread less 1/n, most byte share.
ANY = {"latin": 1.05, "other": 0.2, "most": 12.0, "spread": 0.15, "byte_share": 0.5}
MEASURES = "n_tokens long, chars_per_token double, word_chars double, byte_share double, entropy double, spread double, script string"


#: Code points from which a script begins, and its name; letters below 0x250 are Latin.
SCRIPTS = ((0x250, ""), (0x370, "greek"), (0x400, "cyrillic"), (0x530, ""), (0x590, "hebrew"), (0x600, "arabic"), (0x780, ""), (0x900, "indic"), (0xE00, "thai"), (0xE80, ""), (0x1100, "hangul"), (0x1200, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, ""), (0x20000, "han"), (0x30000, ""))
_NAMES = ["latin", *dict.fromkeys(n for _, n in SCRIPTS if n not in ("", "latin"))]
_EDGES = np.array([e for e, _ in SCRIPTS])
_KINDS = np.array([0, *(_NAMES.index(n) if n else -1 for _, n in SCRIPTS)])
_LETTER = np.zeros(128, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_WORD = _LETTER.copy()
_WORD[range(48, 58)] = True
#: Places for words whose pieces a worker remembers (16 bytes each); a word takes the place of another of the same low bits.
REMEMBERED = 1 << 20
#: Words that are taken apart in one call.
AT_ONCE = 1 << 14
_NO_BLANK = np.zeros(256, bool)
_NO_BLANK[32] = True


class Pieces:
    """Tokens of a piece vocabulary, and those of them that are single bytes for characters it lacks, counted by word.

    No piece has a blank behind another character (checked here), so a text's tokens are those of its words, each with the
    blanks before it, and a word that was seen before needn't be taken apart again. White space that is no blank is always
    spelled as a byte and says nothing about the text: it is not among the bytes.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size()
        self.apart = not any("▁" in self.sp.id_to_piece(i).lstrip("▁") for i in range(n) if not self.sp.is_control(i))
        self.kind = np.array([self.sp.is_byte(i) for i in range(n)])
        self.kind[[i for i in range(n) if self.sp.id_to_piece(i) in ("<0x09>", "<0x0A>", "<0x0B>", "<0x0C>", "<0x0D>")]] = False
        self.names, self.counts = np.zeros(REMEMBERED, np.uint64), np.full((REMEMBERED, 2), -1, np.int32)

    def of(self, text: str) -> tuple[int, int]:
        ids = np.array(self.sp.encode(text), np.int64)
        return len(ids), int(self.kind[ids].sum())

    def of_each(self, texts: list[str]) -> np.ndarray:
        """Both numbers of many texts, a row each."""
        out = np.zeros((len(texts), 2), np.int64)
        for k in range(0, len(texts), AT_ONCE):
            found = self.sp.encode(texts[k : k + AT_ONCE], num_threads=1)
            size = np.fromiter(map(len, found), np.int64, len(found))
            lost = np.concatenate([[0], np.cumsum(self.kind[np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))])])
            end = np.cumsum(size)
            out[k : k + len(found)] = np.column_stack([size, lost[end] - lost[end - size]])
        return out

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both numbers of each text."""
        raw, n = data.tobytes(), len(offsets) - 1
        if not self.apart:
            found = np.array([self.of(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.int64).reshape(n, 2)
            return found[:, 0], found[:, 1]
        starts, ends, first = words(data, offsets, _NO_BLANK)
        text = np.repeat(np.arange(n), np.diff(first))
        # A word begins behind the blank that ends the one before it: with the further blanks between them, if there are any.
        begin = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
        head = first[:-1][np.diff(first) > 0]
        begin[head] = offsets[:-1][np.diff(first) > 0]
        name, one, which = np.unique(hash_spans(data, begin, ends), return_index=True, return_inverse=True)
        place = (name & np.uint64(REMEMBERED - 1)).astype(np.int64)
        known = self.counts[place].astype(np.int64)
        new = np.flatnonzero((self.names[place] != name) | (known[:, 0] < 0))
        known[new] = self.of_each([raw[a:b].decode() for a, b in zip(begin[one[new]].tolist(), ends[one[new]].tolist())])
        self.names[place[new]], self.counts[place[new]] = name[new], known[new]
        each = known[which]
        total, lost = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(total, text, each[:, 0])
        np.add.at(lost, text, each[:, 1])
        # Blanks at a text's end, or of a text that is nothing else.
        last = offsets[:-1].copy()
        np.maximum.at(last, text, ends)
        for k in np.flatnonzero(last < offsets[1:]).tolist():
            blanks = " " * int(offsets[k + 1] - last[k])
            total[k] += self.of("a" + blanks)[0] - self.of("a")[0] if last[k] > offsets[k] else self.of(blanks)[0]
        # The sign that stands for a blank, where a text has it itself.
        at = raw.find(b"\xe2\x96\x81")
        while at >= 0:
            k = int(np.searchsorted(offsets, at, "right")) - 1
            total[k], lost[k] = self.of(raw[offsets[k] : offsets[k + 1]].decode())
            at = raw.find(b"\xe2\x96\x81", offsets[k + 1])
        return total, lost


_pieces: dict[str, Pieces] = {}


def scripts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The script of most letters of each text, as an index of _NAMES (Latin where there is none; ties go to the first)."""
    counts = np.zeros((len(offsets) - 1, len(_NAMES)), np.int64)
    at = np.concatenate([[0], np.cumsum(np.where(data < 128, _LETTER[data & 127], False))])
    counts[:, 0] = at[offsets[1:]] - at[offsets[:-1]]
    many = np.flatnonzero(data >= 0xC3)
    if len(many):
        kind = _KINDS[np.searchsorted(_EDGES, _bpe.code_points(data, many), "right")]
        known = kind >= 0
        text = np.searchsorted(offsets, many[known], "right") - 1
        np.add.at(counts, (text, kind[known]), 1)
    return counts.argmax(1)


def measured_batch(e: _bpe.Encoder, counter: Pieces, column: pa.Array) -> dict[str, pa.Array]:
    """The measures of each text of a column."""
    size = np.int64(len(e.v))
    data, offsets = flat(column)
    ids, first = e.encode(data, offsets)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    _, count = np.unique(doc * size + ids, return_counts=True)
    # A text's distinct tokens follow one another, so sums over them are differences of running sums.
    ends = np.searchsorted(np.cumsum(count), first, "right")
    run_sum = np.concatenate([[0.0], np.cumsum(count * np.log2(count))])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    pieces, lost = counter.count(data, offsets)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.maximum(np.log2(n) - (run_sum[ends[1:]] - run_sum[ends[:-1]]) / n, 0)
        spread = np.where(n > 1, np.minimum(entropy / np.log2(np.minimum(n, size)), 1), 1.0)
        per = (chars[offsets[1:]] - chars[offsets[:-1]]) / n
        share = lost / pieces
        worded = np.concatenate([[0], np.cumsum(np.where(data < 128, _WORD[data & 127], (data & 0xC0) != 0x80))])
        word_chars = (worded[offsets[1:]] - worded[offsets[:-1]]) / n
    held = lambda x: pa.array(np.round(x, 6), pa.float64(), mask=n == 0)
    names = pa.array([_NAMES[k] for k in scripts(data, offsets)], pa.string())
    return {"n_tokens": pa.array(n, pa.int64()), "chars_per_token": held(per), "word_chars": held(word_chars), "byte_share": held(share), "entropy": held(entropy), "spread": held(spread), "script": names}


def measures(docs: DataFrame, path: str = VOCABULARY, pieces: str = PIECES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of each row (the id) and n_tokens, chars_per_token, word_chars, byte_share, entropy, spread, script.

    word_chars: letters, digits and all characters beyond ASCII, a token. byte_share: tokens of the piece vocabulary that are bytes of characters it lacks, of all its tokens. entropy: bits, of the
    byte-level tokens' distribution in the text. spread: entropy against the most that so many tokens can have,
    log2(min(n_tokens, vocabulary)). script: that of most letters. An empty or null text has 0 tokens and null measures.
    Kept columns whose names are those of measures come first, so rename them before.
    """
    spark, keep = docs.sparkSession, keep or ["doc_id"]
    with open(pieces, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    shipped = ship(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, shipped)
        if pieces not in _pieces:
            _pieces[pieces] = Pieces(model.value)
        for batch in batches:
            for part in slices(batch, "_text_"):
                found = measured_batch(e, _pieces[pieces], part.column("_text_"))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found.values()], schema=out)

    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields, *StructType.fromDDL(MEASURES).fields])
    out = to_arrow_schema(schema)
    return docs.select(*keep, docs[text].alias("_text_")).mapInArrow(run, schema)


def draw_bands(good: DataFrame, lang: str = "lang") -> DataFrame:
    """Bands (band, band_size, low_chars, low_words, low_entropy, high_bytes) from every row of good, measured documents.

    band: "l:" and a language, or "s:" and a script (for texts of languages without a good document, or of none). Each size
    has the edges of its own documents, moved out the further the fewer they are. Sizes without any have those of the next
    smaller size; below the smallest, characters a token fall by a tenth for each halving, entropy by a bit, and byte shares
    double. Entropy's edge never falls with size. Measures are rounded to four places, so that a quantile's memory is bounded
    however many documents there are.
    """
    of = good.where("n_tokens > 0").withColumn("band", F.explode(F.array(F.concat(F.lit("l:"), lang), F.concat(F.lit("s:"), "script")))).where("band IS NOT NULL")
    limits = {"low_chars": ("chars_per_token", -1), "low_words": ("word_chars", -1), "low_entropy": ("entropy", -1), "high_bytes": ("byte_share", 1)}
    quantile = lambda m, side: F.percentile(F.round(m, 4), F.lit(TAILS[m] if side < 0 else 1 - TAILS[m]))
    wider = F.pow(F.count(F.lit(1)), F.lit(-WIDER))
    drawn = [(quantile(m, side) * F.greatest(1 + side * (SLACK[m] + wider), F.lit(0.0))).alias(n) for n, (m, side) in limits.items()]
    sizes = of.groupBy("band", size_class().alias("band_size")).agg(*drawn)
    grid = sizes.select("band").distinct().withColumn("band_size", F.explode(F.sequence(F.lit(0), F.lit(LARGEST - 1)))).join(sizes, ["band", "band_size"], "left")
    by_size = Window.partitionBy("band").orderBy("band_size")
    below, above = by_size.rowsBetween(Window.unboundedPreceding, 0), by_size.rowsBetween(0, Window.unboundedFollowing)
    gap = F.first(F.when(F.col("low_chars").isNotNull(), F.col("band_size")), ignorenulls=True).over(above) - F.col("band_size")
    edge = lambda n, moved: F.coalesce(F.last(n, ignorenulls=True).over(below), moved(F.first(n, ignorenulls=True).over(above)))
    shrunk = lambda c: c * F.pow(F.lit(0.9), "gap")
    filled = grid.withColumn("gap", gap).select(
        "band", "band_size", edge("low_chars", shrunk).alias("low_chars"), edge("low_words", shrunk).alias("low_words"),
        edge("low_entropy", lambda c: c - F.col("gap")).alias("low_entropy"), edge("high_bytes", lambda c: c * F.pow(F.lit(2.0), "gap")).alias("high_bytes"),
    )
    few = F.greatest(F.lit(LEAST_BYTES), F.lit(FEW_BYTES) / F.pow(F.lit(2.0), "band_size"))
    return filled.withColumns({"low_entropy": F.max("low_entropy").over(below), "high_bytes": F.greatest("high_bytes", few)})


def size_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def judge(measured: DataFrame, bands: DataFrame, lang: str = "lang") -> DataFrame:
    """Adds reason (the first measure outside its limits; "empty" without tokens; else null) and reject (boolean).

    Texts of every size are held against ANY's limits and the band of their language and size, or, where their language is
    null or unknown, of their script and size; without either, ANY's limits alone decide.
    """
    names = ["band", "band_size", "low_chars", "low_words", "low_entropy", "high_bytes"]
    renamed = lambda p: bands.where(F.col("band").startswith(p)).select(*(F.col(n).alias(f"{p}{n}") for n in names))
    size = size_class()
    joined = measured.join(_hinted(renamed("l:"), bands), (F.concat(F.lit("l:"), lang) == F.col("`l:band`")) & (size == F.col("`l:band_size`")), "left")
    joined = joined.join(_hinted(renamed("s:"), bands), (F.concat(F.lit("s:"), "script") == F.col("`s:band`")) & (size == F.col("`s:band_size`")), "left")
    limit = lambda n: F.when(F.col("`l:band`").isNotNull(), F.col(f"`l:{n}`")).otherwise(F.col(f"`s:{n}`"))
    n, chars = F.col("n_tokens"), F.col("chars_per_token")
    least = F.when(F.col("script") == "latin", ANY["latin"]).otherwise(ANY["other"])
    reason = (
        F.when(n == 0, F.lit("empty"))
        .when((chars < least - 1 / n) | (chars > ANY["most"] + 100 / n), F.lit("chars_per_token"))
        .when(F.col("byte_share") > F.greatest(F.lit(ANY["byte_share"]), FEW_BYTES / n), F.lit("byte_share"))
        .when(F.col("spread") < ANY["spread"] - 1 / n, F.lit("spread"))
        .when(chars < limit("low_chars"), F.lit("chars_per_token"))
        .when(F.col("word_chars") < limit("low_words"), F.lit("word_chars"))
        .when(F.col("entropy") < limit("low_entropy"), F.lit("entropy"))
        .when(F.col("byte_share") > limit("high_bytes"), F.lit("byte_share"))
    )
    return joined.withColumn("reason", reason).withColumn("reject", F.col("reason").isNotNull()).select(*(F.col(f"`{c}`") for c in measured.columns), "reason", "reject")


def _hinted(part: DataFrame, bands: DataFrame) -> DataFrame:
    """A part of the bands with their own hint: broadcast where their size was checked."""
    return part.hint("broadcast") if getattr(bands, "_small", False) else part


def known_good(labels: DataFrame) -> DataFrame:
    """(good_id): ids that labels call good (quality 1)."""
    return labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("good_id")).where(F.col("good_id").isNotNull()).distinct()


def checked(bands: DataFrame) -> DataFrame:
    """The bands, stored, and marked as small where `_tables.fits` finds them so (languages times sizes, whatever the number
    of documents, but a column of languages may hold anything)."""
    kept = stored(bands)
    kept._small = fits(kept)
    return kept


def rules(docs: DataFrame, labels: DataFrame, path: str = VOCABULARY, pieces: str = PIECES) -> DataFrame:
    """Measures and verdict of each row of docs (doc_id, text, lang): doc_id, lang, the measures, reason, reject.

    labels (doc_id, quality): the documents of quality 1 draw the bands; all of them are used. Rows with a null id are
    judged but draw nothing; repeated rows, also with different texts, are judged each for itself and draw as often as they
    come. A very long text is measured whole. The texts are read once: measures, a few numbers a row, are stored before bands
    are drawn. An empty table gives an empty result; without labels, only ANY's limits reject. Further columns don't matter.
    """
    measured = stored(measures(docs, path, pieces, keep=["doc_id", "lang"]))
    return judge(measured, checked(draw_bands(measured.join(beside(known_good(labels)), F.col("doc_id") == F.col("good_id"), "left_semi"))))


def op8_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`rules` over the documents table."""
    return rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def reject_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that the rules keep, all columns.

    Labelled good documents are measured first and draw the bands; then every row is measured and judged where it is, so a
    null id, an id that repeats with another text, or clashing columns change nothing, and texts aren't shuffled. Empty and
    null texts go; repeated rows stay or go together; an empty table stays empty.
    """
    good = docs.join(beside(known_good(table(spark, sf_dir, "labels"))), F.col("doc_id") == F.col("good_id"), "left_semi")
    bands = checked(draw_bands(measures(good, keep=["lang"])))
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    held = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    judged = judge(measures(held, text=names["text"], keep=list(names.values())), bands, names["lang"])
    return judged.where(~F.col("reject")).select(*(F.col(n).alias(c) for c, n in names.items()))
