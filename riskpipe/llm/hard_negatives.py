"""Hard negatives by exact inner products of anchor and candidate blocks.

1. Components become whole numbers, ``floor(256 * x)``; a score is the inner product of two such
   vectors, a shorter one continued by zeros. A vector whose squares add up to 2^63 or more has scores
   that no long holds; its row takes no part, as do rows that lack a label, a vector or a finite component.
2. Anchors and candidates are dealt evenly into blocks by a hash of the row; a cell of the grid of
   blocks is one group of a task, so that neither side is ever whole anywhere, whatever label or vector
   is frequent. Both sides of a cell are bounded by ``BLOCK_NUMBERS`` components.
3. A cell is multiplied tile by tile by Strassen's recursion on 64-bit integers, odd sides padded with
   a zero row or column. Sums wrap around at 2^64 on the way, so that any score that fits is exact.
4. First pass: a heap of the best same-label rows an anchor, merged over tiles, then over cells. Second
   pass, with the positives' scores known: a heap for each anchor and positive of the best rows of
   other labels in its window, merged in the same way.

Higher scores come first, then smaller ids, null ids last (they stand for the largest long, which must
not be an id itself). Repeated rows are rows of their own: an anchor's copy may be its positive. An
anchor without positives, or a positive without rows in its window, has no result row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpipe.llm.shared import checkpointed

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A window reaches from so many hundredths of a positive's score up to all of it.
LOW_PERCENT = 80
#: Squares of a vector may add up to this (below 2^63 by more than the sum in doubles can be off).
MAX_SQUARES = 9.2e18
#: Components of a block of candidates, those of a block of anchors, and the least number of blocks.
BLOCK_NUMBERS, ANCHOR_NUMBERS, LEAST_BLOCKS = 1 << 22, 1 << 19, 64
#: Rows of a tile, and sides up to which a product is made directly.
TILE_ANCHORS, TILE_ROWS, LEAF = 256, 1024, 32
NO_ID = (1 << 63) - 1


# ---------------------------------------------------------------- products


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices modulo 2^64, by seven products of quarters."""
    if min(*a.shape, len(b)) <= leaf:
        return a @ b.T
    m, n = len(a), len(b)
    a, b = (np.pad(side, [(0, s % 2) for s in side.shape]) for side in (a, b))
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    product = np.empty((2 * i, 2 * j), np.int64)
    product[:i, :j] = p1 + p4 - p5 + p7
    product[:i, j:] = p3 + p5
    product[i:, :j] = p2 + p4
    product[i:, j:] = p1 - p2 + p3 + p6
    return product[:m, :n]


def _lengths(lists: pa.ChunkedArray) -> np.ndarray:
    return np.diff(lists.combine_chunks().offsets.to_numpy())


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of ``width`` numbers from lists of at most so many, zeros behind shorter ones."""
    rows = np.zeros((len(lists), width), np.int64)
    rows[np.arange(width) < _lengths(lists)[:, None]] = lists.combine_chunks().flatten().to_numpy()
    return rows


Heap = tuple[np.ndarray, np.ndarray, np.ndarray]  # key, score, id: the best few of each key


def merged(one: Heap, other: Heap, size: int) -> Heap:
    """The best ``size`` entries of each key of two heaps, in order."""
    key, score, ident = (np.concatenate(pair) for pair in zip(one, other, strict=True))
    order = np.lexsort((ident, -score, key))
    key, score, ident = key[order], score[order], ident[order]
    first = np.searchsorted(key, key)
    best = np.arange(len(key)) - first < size
    return key[best], score[best], ident[best]


def _no_heap() -> Heap:
    return (np.zeros(0, np.int64),) * 3


def positive_heap(scores: np.ndarray, same: np.ndarray, ids: np.ndarray, size: int) -> Heap:
    """The best ``size`` of the ``same`` columns of every row; keys are row numbers."""
    lowest = np.iinfo(np.int64).min
    open_ = np.where(same, scores, lowest)
    if scores.shape[1] > size:
        cut = np.partition(open_, -size, axis=1)[:, -size]
        same = same & (open_ >= cut[:, None])
    key, column = np.nonzero(same)
    return merged((key, scores[key, column], ids[column]), _no_heap(), size)


def window_heap(
    scores: np.ndarray, other: np.ndarray, ids: np.ndarray, highs: np.ndarray, size: int
) -> Heap:
    """The best ``size`` of the ``other`` columns in each window; keys are row * windows + window.

    ``highs`` has a row of window tops for every row of ``scores``; unused ones are negative.
    """
    heap = _no_heap()
    for slot in range(highs.shape[1]):
        high = highs[:, slot, None]
        inside = other & (scores <= high) & (scores >= lowest_score(high))
        key, column = np.nonzero(inside)
        found = (key * highs.shape[1] + slot, scores[key, column], ids[column])
        heap = merged(heap, found, size)
    return heap


def lowest_score(high: np.ndarray) -> np.ndarray:
    """The least n with 100 n >= ``LOW_PERCENT`` * high, without passing 64 bits."""
    return high // 100 * LOW_PERCENT - (-(high % 100 * LOW_PERCENT) // 100)


# ---------------------------------------------------------------- cells


def _cell_function(find: Callable, slots: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From the anchors and the candidates of a cell to the rows of its heaps, ``slots`` an anchor."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heaps = [_no_heap()]
        if anchors.num_rows and rows.num_rows:
            width = max(int(_lengths(t["vector"]).max()) for t in (anchors, rows))
            a, b = (matrix(t["vector"], width) for t in (anchors, rows))
            labels, of_row, ids = (c.to_numpy() for c in (anchors["label"], rows["label"], rows["id"]))
            for at in range(0, len(a), TILE_ANCHORS):
                here, heap = slice(at, at + TILE_ANCHORS), _no_heap()
                for first in range(0, len(b), TILE_ROWS):
                    there = slice(first, first + TILE_ROWS)
                    same = labels[here, None] == of_row[None, there]
                    scores = strassen(a[here], b[there])
                    heap = find(heap, scores, same, ids[there], anchors.slice(at, TILE_ANCHORS))
                heaps.append((heap[0] + at * slots, *heap[1:]))
        key, score, ident = (np.concatenate(c) for c in zip(*heaps, strict=True))
        anchor = anchors["anchor"].to_numpy()[key // slots]
        return pa.table({"anchor": anchor, "slot": key % slots, "score": score, "id": ident})

    return run


def _positives(heap: Heap, scores: np.ndarray, same: np.ndarray, ids: np.ndarray, anchors: pa.Table) -> Heap:
    size = POSITIVES + 1  # the anchor is one of its rows
    return merged(heap, positive_heap(scores, same, ids, size), size)


def _negatives(heap: Heap, scores: np.ndarray, same: np.ndarray, ids: np.ndarray, anchors: pa.Table) -> Heap:
    highs = matrix(anchors["highs"], POSITIVES)
    highs[np.arange(POSITIVES) >= _lengths(anchors["highs"])[:, None]] = -1
    return merged(heap, window_heap(scores, ~same, ids, highs, NEGATIVES), NEGATIVES)


HEAP_ROWS = "anchor long, slot long, score long, id long"


def _crossed(anchors: DataFrame, rows: DataFrame, grid: tuple[int, int], find: Callable, slots: int) -> DataFrame:
    """The heaps of all cells of the grid: ``anchor, slot, score, id``."""
    down, across = grid

    def copied(df: DataFrame, times: int) -> DataFrame:
        return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))

    strip = F.pmod(F.xxhash64("anchor"), F.lit(down))
    block = F.pmod(F.xxhash64("id", "vector", "label"), F.lit(across))
    anchors = copied(anchors, across).withColumn("cell", strip * across + F.col("copy")).drop("copy")
    rows = copied(rows, down).select("id", "label", "vector", (F.col("copy") * across + block).alias("cell"))
    run = _cell_function(find, slots)
    return anchors.groupBy("cell").cogroup(rows.groupBy("cell")).applyInArrow(run, HEAP_ROWS)


def scorable(df: DataFrame, anchor: Column, label: Column) -> DataFrame:
    """``id, label, is_anchor, vector`` of the rows of ``df`` that take part; vectors in whole numbers.

    ``df`` has ``vec_id`` and ``embedding``; other columns are free to use in ``anchor`` and ``label``.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x.cast("double") * SCALE).cast("double"), 2)
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return (
        df.filter(label.isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
        .filter(squares <= MAX_SQUARES)
        .select(
            F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
            label.cast("long").alias("label"),
            F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
            whole.alias("vector"),
        )
    )


def hard_negatives(rows: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``scorable`` rows."""
    sizes = rows.agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("anchors"), F.max(F.size("vector")).alias("width")
    ).first()
    per_block = max(1, BLOCK_NUMBERS // max(1, sizes["width"] or 1))
    per_strip = max(1, ANCHOR_NUMBERS // max(1, sizes["width"] or 1))
    grid = max(1, math.ceil(sizes["anchors"] / per_strip)), max(LEAST_BLOCKS, math.ceil(sizes["n"] / per_block))
    anchors = checkpointed(
        rows.filter("is_anchor").select(
            F.monotonically_increasing_id().alias("anchor"),
            F.col("id").alias("anchor_id"),
            "label",
            "vector",
            F.aggregate("vector", F.lit(0).cast("long"), lambda total, x: total + x * x).alias("own"),
        )
    )
    first_pass = _crossed(anchors.select("anchor", "label", "vector"), rows, grid, _positives, 1)
    positives = checkpointed(_without_self(_best(first_pass, ["anchor"], POSITIVES + 1), anchors))
    highs = positives.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "score"))), lambda p: p["score"]).alias("highs")
    )
    sought = anchors.select("anchor", "label", "vector").join(highs, "anchor")
    second_pass = _crossed(sought, rows, grid, _negatives, POSITIVES)
    negatives = _best(second_pass, ["anchor", "slot"], NEGATIVES)
    a, p, n = (t.alias(c) for t, c in ((anchors, "a"), (positives, "p"), (negatives, "n")))

    def named(column: str) -> Column:
        return F.when(F.col(column) != NO_ID, F.col(column))

    return (
        n.join(p, ["anchor", "slot"])
        .join(a, "anchor")
        .select(
            F.col("a.anchor_id"),
            named("p.id").alias("positive_id"),
            F.col("n.place").alias("rank"),
            named("n.id").alias("negative_id"),
            F.col("p.score").alias("positive_score"),
            F.col("n.score").alias("negative_score"),
        )
    )


def _best(heaps: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Heaps of several cells merged; ``place`` counts from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return heaps.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)


def _without_self(best: DataFrame, anchors: DataFrame) -> DataFrame:
    """``anchor, slot, score, id`` of the positives: one entry that equals the anchor itself is taken out."""
    known = best.join(anchors.select("anchor", "anchor_id", "own"), "anchor")
    itself = F.when((F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own")), F.col("place"))
    at = F.min(itself).over(Window.partitionBy("anchor"))
    slot = F.col("place") - F.when(F.col("place") > F.col("at"), 2).otherwise(1)
    return (
        known.withColumn("at", at)
        .filter(~F.col("place").eqNullSafe(F.col("at")))
        .select("anchor", slot.cast("long").alias("slot"), "score", "id")
        .filter(F.col("slot") < POSITIVES)
    )


def from_embeddings(df: DataFrame) -> DataFrame:
    """The result for a table of ``vec_id, embedding, label``: anchors are every hundredth id.

    Rows whose id is divisible by 7 get the label after theirs, of ten.
    """
    ident, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(F.coalesce(ident % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    return hard_negatives(scorable(df, ident % 100 == 0, moved))
