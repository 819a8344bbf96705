"""Fingerprints of documents by one-permutation MinHash.

A text's shingles of five words (the whole text, where it has fewer) are hashed once. The top bits
of a hash choose one of 128 bins, the least value in a bin is its minimum. An empty bin borrows the
minimum of another bin, which it finds along its own pseudo-random sequence of bins (optimal
densification): the first that is filled lends. Of each minimum the low eight bits are stored,
packed into sixteen longs. Two fingerprints agree by chance in one of 256 bins; the estimate of the
similarity takes that off.

Only built-in functions are used, over one row at a time. A null text is empty. A text without words
has the empty fingerprint, which is wholly like itself (1.0) and unlike all others (0.0).

The next document is the one with the next smaller ``doc_id``, null ids last; after the last comes
the first. Rows that repeat an id and a text are one document, and each of them gets its result;
different texts under one id follow each other by their hash. A table of one document is its own
neighbour. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpipe.llm.quality_rules import let, words
from riskpipe.llm.shared import checkpointed, texts

SHINGLE_WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
STORED_BITS = 8
#: Steps of a bin's sequence that are written out; the rest of it is searched at once.
TRIES = 6


def shingle_hashes(text: Column) -> Column:
    """Non-negative 63-bit hashes of a text's shingles, in order, repeated ones too."""

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - SHINGLE_WORDS)
        several = F.transform(
            starts, lambda i: _positive(F.xxhash64(*(hashes[i + k] for k in range(SHINGLE_WORDS))))
        )
        return (
            F.when(F.size(hashes) >= SHINGLE_WORDS, several)
            .when(F.size(hashes) > 0, F.array(_positive(F.xxhash64(hashes))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), windows)


def _positive(value: Column) -> Column:
    return F.shiftrightunsigned(value, 1)


def _bin(value: Column) -> Column:
    return F.shiftright(value, 63 - BIN_BITS).cast("int")


def _start(i: Column) -> Column:
    """Where the sequence of bin i starts; with ``_stride`` odd it visits every bin."""
    return F.xxhash64(F.lit("start"), i).bitwiseAND(BINS - 1).cast("int")


def _stride(i: Column) -> Column:
    return F.xxhash64(F.lit("stride"), i).bitwiseAND(BINS - 1).bitwiseOR(1).cast("int")


def _visit(i: Column, step: Column) -> Column:
    return (_start(i) + step * _stride(i)).bitwiseAND(BINS - 1)


def densified(bins: Column) -> Column:
    """The array of bins with each null replaced by its lender's value; one bin at least is filled."""
    steps = F.sequence(F.lit(TRIES), F.lit(BINS - 1))

    def lender(i: Column) -> Column:
        later = F.filter(
            F.transform(steps, lambda t: F.get(bins, _visit(i, t))), lambda v: v.isNotNull()
        )
        first = [F.get(bins, _visit(i, F.lit(t))) for t in range(TRIES)]
        return F.coalesce(F.get(bins, i), *first, F.get(later, F.lit(0)))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lender)


def fingerprint(text: Column) -> Column:
    """Sixteen longs with the low bits of 128 minima; no longs for a text without words."""

    def minima(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda v, i: (i == 0) | (_bin(v) != _bin(ordered[F.greatest(i - 1, F.lit(0))])),
        )

    def bins(least: Column) -> Column:
        by = F.map_from_arrays(F.transform(least, _bin), least)
        return let(
            by, lambda m: F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: m[i])
        )

    def packed(values: Column) -> Column:
        per_long = 64 // STORED_BITS
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // per_long - 1)),
            lambda g: sum(
                (
                    F.shiftleft(
                        values[g * per_long + k].bitwiseAND((1 << STORED_BITS) - 1),
                        k * STORED_BITS,
                    )
                    for k in range(1, per_long)
                ),
                start=values[g * per_long].bitwiseAND((1 << STORED_BITS) - 1),
            ),
        )

    def of(hashes: Column) -> Column:
        return F.when(
            F.size(hashes) > 0,
            let(
                F.sort_array(hashes),
                lambda s: let(
                    minima(s), lambda m: let(bins(m), lambda b: let(densified(b), packed))
                ),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return let(shingle_hashes(text), of)


def as_text(longs: Column) -> Column:
    """A fingerprint in hexadecimal, sixteen digits a long."""
    return F.array_join(F.transform(longs, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """The estimated similarity of two fingerprints, 0 to 1, free of chance agreement."""
    ones = F.lit(0x0101010101010101)

    def differing(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(ones))

    different = F.aggregate(
        F.zip_with(one, other, differing), F.lit(0), lambda total, n: total + n
    )
    chance = 2.0**-STORED_BITS
    estimate = (1 - different / BINS - chance) / (1 - chance)
    return (
        F.when((F.size(one) == 0) & (F.size(other) == 0), 1.0)
        .when((F.size(one) == 0) | (F.size(other) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), estimate))
    )


#: A document's key: its id, 0 if there is none, whether there is none, and a hash of the text. Plain
#: columns, so that both uses of the texts' shuffle are one.
KEY = ["id", "none", "tie"]
PREVIOUS = ["prev_id", "prev_none", "prev_tie"]


def _key(doc_id: Column, tie: Column) -> list[Column]:
    return [
        F.coalesce(doc_id, F.lit(0)).alias("id"),
        doc_id.isNull().alias("none"),
        tie.alias("tie"),
    ]


def neighbours(df: DataFrame) -> DataFrame:
    """The ``KEY`` of each document, with ``prev_id, prev_none, prev_tie, prev_chars`` of the one before.

    ``df`` has ``doc_id, tie, n_chars``. Ids alone are dealt into ranges; a document looks for the
    one before it inside its range, and a range's first in a table of one row per range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ranges = checkpointed(
        df.dropDuplicates(["doc_id", "tie"])
        .repartitionByRange(parts, *order)
        .withColumn("part", F.spark_partition_id())
    )
    inside = Window.partitionBy("part").orderBy(*order)
    here = F.struct("doc_id", "tie", "n_chars")
    linked = ranges.select(
        "doc_id",
        "tie",
        "part",
        F.lag(here).over(inside).alias("before"),
        F.row_number().over(inside).alias("at"),
    )
    # the last of each range: least id, null ids behind all others, then the largest hash
    key = F.struct(
        F.col("doc_id").isNull().cast("int").alias("null_id"), (-F.col("doc_id")).alias("down"), "tie"
    )
    ends = ranges.groupBy("part").agg(F.max_by(here, key).alias("end"))
    every = Window.orderBy("part")
    borders = ends.select(
        "part",
        F.coalesce(
            F.lag("end").over(every),
            F.last("end").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("border"),
    )
    found = linked.join(F.broadcast(borders), "part")
    prev = F.when(F.col("at") == 1, F.col("border")).otherwise(F.col("before"))
    return found.select(
        *_key(F.col("doc_id"), F.col("tie")),
        *(c.alias(n) for c, n in zip(_key(prev["doc_id"], prev["tie"]), PREVIOUS, strict=True)),
        prev["n_chars"].alias("prev_chars"),
    )


def fingerprints(df: DataFrame) -> DataFrame:
    """``doc_id, n_chars`` and the ``fingerprint`` (longs) of every text."""
    text = F.col("text")
    return texts(df).select(
        "doc_id", F.length(text).cast("long").alias("n_chars"), fingerprint(text).alias("fingerprint")
    )


def with_next(df: DataFrame) -> DataFrame:
    """Every text with its ``fingerprint``, the ``edited`` text and the next one's ``next_print``.

    The edited text ends, in its last half, with the start of the next document. Each document sends
    that start, cut to size, to the one before it; both meet in the partitioning by id.
    """
    text = F.col("text")
    tied = texts(df).withColumn("tie", F.xxhash64("text"))
    links = checkpointed(
        neighbours(tied.select("doc_id", "tie", F.length(text).alias("n_chars")))
    )
    printed = tied.select(
        *_key(F.col("doc_id"), F.col("tie")), "text", fingerprint(text).alias("fingerprint")
    )
    starts = (
        printed.join(links, KEY)
        .select(
            *(F.col(p).alias(k) for p, k in zip(PREVIOUS, KEY, strict=True)),
            F.substring("text", F.lit(1), F.floor(F.col("prev_chars") / 2).cast("int")).alias("start"),
            F.col("fingerprint").alias("next_print"),
        )
        .groupBy(*KEY)
        .agg(F.first("start").alias("start"), F.first("next_print").alias("next_print"))
    )
    n = F.length("text")
    first_half = F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int"))
    return printed.join(starts, KEY).select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"),
        "text",
        "fingerprint",
        F.concat(first_half, "start").alias("edited"),
        "next_print",
    )


def fingerprint_report(df: DataFrame) -> DataFrame:
    """Fingerprints of all texts and edited texts, and their likeness."""
    compared = with_next(df).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_print",
    )
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fingerprint")).alias("fingerprint"),
        as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
