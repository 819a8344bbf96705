"""Packing token sequences of bounded length by non-negative least squares.

1. Documents become ids, longer ones are cut into full pieces and a rest.
2. The pieces' lengths are counted; no more than one row per length reaches the driver.
3. Patterns of two or three lengths that fill a sequence exactly are enumerated, and repeat counts
   are fitted to the histogram by non-negative least squares (accelerated projected gradient).
   Long lengths weigh more, so that what is left over is short and easy to place.
4. The counts are rounded, cut back to the pieces there are, and the residual lengths are packed
   best-fit decreasing, by whole groups of equal sequences.
5. The plan is a table of (length, range of ranks) -> place. Pieces are ranked within their length
   by Spark, in hash chunks, so that no length lands in one task, and joined to the plan.

The plan is broadcast: its rows are bounded by the capacity (``THINNING`` patterns of at most three
lengths, and a residual of at most a few entries per length), not by the data. The fit runs on the
driver over ``capacity`` numbers.

Null texts are empty; each document has at least its end id, so every row has a piece. Repeated
rows and ids are packed once per row; an empty table has an empty plan.
"""

from __future__ import annotations

import functools
import math
import os
import re
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskpipe.llm.shared import checkpointed, map_columns, texts

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Every so many triples of lengths are patterns; each length still stands in dozens of them.
THINNING = 8
FIT_STEPS = 400
#: Rows that one task ranks, at most a few times as many.
CHUNK_ROWS = 50_000
#: Words a Python worker remembers the ids of, twice (as they stand, and in lower case), and the
#: longest of them.
CACHED_WORDS = 400_000
CACHED_CHARS = 40


# ---------------------------------------------------------------- tokens


#: A word of letters whose lower case and normal form are plain, with a mark behind it or none.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]?)")
#: Byte-level models write a byte that is no visible character as one from 256 on, in turn.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_SIGNS = {b: chr(b) if b in _VISIBLE else chr(256 + _HIDDEN.index(b)) for b in range(256)}


class WordIds(dict):
    """The ids of blank-separated words as bytes, encoded when first met and remembered for a while.

    A plain word is one piece for the model and skips the library's general way to it, which takes
    longer; a mark behind it is a piece of its own. All other words go through the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.coder = Tokenizer.from_file(path)
        self.model = self.coder.model
        self.letters: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        plain = _PLAIN.fullmatch(text) if len(text := word.decode()) <= CACHED_CHARS else None
        if plain and plain[2]:
            ids = self._letters(plain[1].lower()) + self[plain[2].encode()]
        elif plain:
            ids = self._letters(plain[1].lower())
        else:
            ids = _packed(self.coder.encode(text, add_special_tokens=False).ids)
        if len(text) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _letters(self, word: str) -> bytes:
        ids = self.letters.get(word)
        if ids is None:
            signs = "".join([_SIGNS[b] for b in word.encode()])
            ids = _packed([token.id for token in self.model.tokenize(signs)])
            if len(self.letters) >= CACHED_WORDS:
                self.letters.clear()
            self.letters[word] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_word_ids = functools.cache(WordIds)


def token_bytes(text: str, path: str) -> bytes:
    """Little-endian ids of a text, with the end id.

    The tokenizer drops white space and never joins across it (nor does its normalizer), so a text's
    ids are those of its blank-separated words in turn.
    """
    known = _word_ids(path)
    return b"".join([known[w] for w in text.encode().split()]) + _packed([END_ID])


def pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start`` and the ``ids`` (binary, four bytes an id) of every piece."""
    step = 4 * capacity

    def rows(keys: list, bodies: list[str]) -> list[tuple]:
        return [
            (k, at // step, at // 4, ids[at : at + step])
            for k, text in zip(keys, bodies, strict=True)
            for ids in [token_bytes(text, tokenizer)]
            for at in range(0, len(ids), step)
        ]

    return map_columns(texts(df), rows, "doc_id", "piece int, start long, ids binary")


# ---------------------------------------------------------------- plan


def patterns(lengths: np.ndarray, capacity: int, thinning: int = THINNING) -> np.ndarray:
    """Rows of three lengths, the last may be 0, that add up to the capacity."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    present[0] = True
    first, second = np.meshgrid(lengths, lengths, indexing="ij")
    third = capacity - first - second
    good = (first >= second) & (second >= third) & (third >= 0)
    good &= (third == 0) | ((first * 31 + second * 17) % thinning == 0)
    good[good] = present[third[good]]
    return np.stack([first[good], second[good], third[good]], axis=1)


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the weighted squares of (lengths used - histogram)."""
    size = len(histogram)
    weight = np.sqrt(np.arange(size) / (size - 1))
    weight[0] = 0.0

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(column, x, size) for column in rows.T)

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[column] for column in rows.T)

    square = weight * weight
    bound, v = 1.0, np.ones(len(rows))
    for _ in range(20):
        v = back(square * used(v))
        bound = float(np.linalg.norm(v))
        v /= bound
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        x_next = np.maximum(0.0, y - back(square * (used(y) - histogram)) / (1.05 * bound))
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y = x_next + (t - 1) / t_next * (x_next - x)
        x, t = x_next, t_next
    return x


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: rows (length, first rank, last rank, sequence, offset, copies).

    Ranks are counted within a length, the last is exclusive. Rank r of a row lies in sequence
    ``sequence + (r - first) // copies`` at ``offset + (r - first) % copies * length``.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    if left[capacity]:
        groups.append((int(left[capacity]), [(capacity, 1)]))
        left[capacity] = 0
    rows = patterns(np.flatnonzero(left), capacity) if left.any() else np.zeros((0, 3), int)
    if len(rows):
        repeats = fit(rows, left.astype(float))
        # fractions are rounded up as often as they say, by a fixed sequence
        golden = np.arange(len(rows)) * ((math.sqrt(5) - 1) / 2) % 1
        whole = np.floor(repeats + golden).astype(np.int64)
        for index in np.argsort(-repeats, kind="stable"):
            if not whole[index]:
                continue
            slots = [(n, int(k)) for n, k in zip(*np.unique(rows[index], return_counts=True)) if n]
            n = min(int(whole[index]), *(int(left[length]) // k for length, k in slots))
            if n > 0:
                groups.append((n, [(int(length), k) for length, k in slots[::-1]]))
                for length, k in slots:
                    left[length] -= n * k
    groups += residual(left, capacity)
    return _ranges(groups)


def residual(left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over counts: groups of (equal sequences, their (length, copies))."""
    spaces: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    rooms: list[int] = []  # spaces with groups, sorted

    def put(room: int, group: tuple[int, list[tuple[int, int]]]) -> None:
        if not spaces[room]:
            insort(rooms, room)
        spaces[room].append(group)

    for length in map(int, np.flatnonzero(left)[::-1]):
        n = int(left[length])
        while n:
            place = bisect_left(rooms, length)
            if place == len(rooms):
                each = min(capacity // length, n)
                many = n // each
                put(capacity - each * length, (many, [(length, each)]))
                n -= many * each
                continue
            room = rooms[place]
            many, slots = spaces[room].pop()
            if not spaces[room]:
                rooms.pop(place)
            each = min(room // length, n)
            filled = min(many, n // each)
            put(room - each * length, (filled, [*slots, (length, each)]))
            if many > filled:
                put(room, (many - filled, slots))
            n -= filled * each
    return [group for room in sorted(spaces) for group in spaces[room]]


def _ranges(groups: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple]:
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for n, slots in groups:
        offset = 0
        for length, copies in slots:
            first = taken[length]
            taken[length] += n * copies
            rows.append((length, first, taken[length], sequence, offset, copies))
            offset += length * copies
        sequence += n
    return rows


# ---------------------------------------------------------------- placement


def ranked(df: DataFrame, n_rows: int, order: list[str]) -> DataFrame:
    """``df`` with a ``rank`` from 0 within each ``length``, counted in chunks of bounded size."""
    chunks = max(1, n_rows // CHUNK_ROWS)
    chunked = df.withColumn("chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sizes = chunked.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk")
    starts = sizes.select(
        "length",
        "chunk",
        (F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("s"),
    )
    local = Window.partitionBy("length", "chunk").orderBy(*order)
    return (
        chunked.withColumn("r", F.row_number().over(local) - 1)
        .join(starts, ["length", "chunk"])
        .withColumn("rank", F.col("r") + F.col("s"))
        .drop("chunk", "r", "s")
    )


def placed(df: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``df`` (``doc_id, piece, length`` and more) with ``sequence_id`` and ``offset``.

    Read twice, for the histogram and for the placement: pass a checkpointed frame.
    """
    counts = {r["length"]: r["n"] for r in df.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(counts, capacity)
    places = df.sparkSession.createDataFrame(
        rows, "length long, first long, last long, sequence long, offset long, copies long"
    )
    order = ["doc_id", "piece", *(c for c in df.columns if c not in ("doc_id", "piece", "length"))]
    ranks = ranked(df, sum(counts.values()), order).alias("d")
    place = F.broadcast(places).alias("p")
    found = (
        (F.col("d.length") == F.col("p.length"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("last"))
    )
    step = F.col("rank") - F.col("first")
    return ranks.join(place, found).select(
        *(F.col(f"d.{c}") for c in df.columns),
        (F.col("sequence") + F.floor(step / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("offset") + step % F.col("copies") * F.col("d.length")).alias("offset"),
    )


def pack(df: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Where every piece of every document goes, with a digest of its ids."""
    cut = pieces(df, tokenizer, capacity).select(
        "doc_id",
        "piece",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return placed(checkpointed(cut), capacity)


def sequences(df: DataFrame, placement: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (binary), pieces in their order.

    ``doc_id`` must name a document; pieces are cut again rather than kept through the placement.
    """
    cut = pieces(df, tokenizer, capacity).join(
        placement.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"]
    )
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return cut.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids")
    )
