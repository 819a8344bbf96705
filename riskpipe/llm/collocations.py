"""Phrases of two to four words that stand together more often than their parts would.

Texts are lower-cased (A to Z), cut into pieces at punctuation and line ends, and the pieces into
words. All counts are per ``lang`` (null: ``und``). A phrase's score is the least, over its cuts in two
parts, of ``SCALE`` * its count / (the counts of both parts), rounded down.

1. Words are counted. The most frequent (lang, word) pairs, at most ``HEAD`` of them, get their rank
   as id; a rarer one with ``LEAST`` or more occurrences gets a hash, verified to be no other word's.
   Other words cannot stand in a phrase that counts, and break a piece.
2. Texts become ids, once, as a table of long runs.
3. Pairs of ids are counted tile by tile: both ranks are cut into ranges of ``TILE``, and a tile with many
   pairs is counted by direct address (``bincount``), the others as sorted coordinates. Tasks emit
   partial counts, which Spark adds up.
4. Pairs with ``LEAST`` or more occurrences are ranked again, by their own frequency, and take the place
   of the first word: (pair, word) gives three words, (triple, word) four, where the words before
   and the words behind both are frequent phrases themselves. Beyond ``HEAD`` phrases, the rarer
   are told from infrequent ones by a bitmap of ``SIEVE_BITS`` bits that may let some through, which
   then fail at their own count.
5. Counts of parts are joined to the phrases: single words by a broadcast of the head, which holds all
   keys that many phrases share, the rest by a shuffle. Phrases inside longer ones that are nearly as frequent
   go, and the best of every lang are ranked.

Only the heads (``HEAD`` rows a level) and the bitmaps are broadcast or pass the driver. A null or empty
text has no words; repeated rows and ids count as often as they stand there; ids have no part in it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskpipe.llm.shared import checkpointed, slices, workspace
from riskpipe.llm.word_table import squeezed, unsqueezed

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
#: A phrase goes if a longer one around it has so many hundredths of its occurrences.
COVERED_PERCENT = 80
TOP = 2000
#: Ranks are below this power of two, at every level.
HEAD_POWER = 18
HEAD = 1 << HEAD_POWER
TILE_POWER = 10
TILE = 1 << TILE_POWER
#: A tile with so many pairs in a buffer is counted by direct address.
DENSE = TILE * TILE >> 4
SIEVE_BITS = 1 << 24
#: Distinct words, ids and phrases that a task holds before it hands them on, and rows of a batch.
HELD_WORDS, HELD_IDS, HELD_GRAMS, SENT_ROWS = 1 << 18, 1 << 18, 1 << 20, 1 << 16
BREAK = -1
UNKNOWN = "und"

_CUT = re.compile(rb"[.,;:!?\x0a-\x0d]+")
_U = np.uint64


# ---------------------------------------------------------------- words and ids


def tokens(text: str) -> list[bytes]:
    """The words of a text; a point, which no word holds, stands between its pieces."""
    return _CUT.sub(b" . ", text.encode().lower()).split()


def _rows(df: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    return df.select(lang, F.coalesce("text", F.lit("")).alias("text"))


def word_counts(df: DataFrame) -> DataFrame:
    """``lang, word, n``; the row without a word has the number of all words of the lang."""

    def emit(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, numbers = [], [], []
        for lang, counter in counts.items():
            counter.pop(b".", None)
            langs += [lang] * (len(counter) + 1)
            words += [w.decode() for w in counter] + [None]
            numbers += [*counter.values(), counter.total()]
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(langs, pa.string()), "word": pa.array(words, pa.string()), "n": pa.array(numbers, pa.int64())}
        )

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for langs, bodies in slices(source):
            for lang, text in zip(langs, bodies, strict=True):
                counts.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, counts.values())) >= HELD_WORDS:
                yield emit(counts)
                counts = {}
        if counts:
            yield emit(counts)

    return (
        _rows(df)
        .mapInArrow(batches, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
    )


def head_floor(counted: DataFrame, head: int) -> int:
    """The count from which on at most ``head`` rows of ``counted`` (``n``) are; by a histogram of its powers."""
    step = F.floor(F.log2("n") * 16)
    # the least count of each step, and the rows from there on
    steps = sorted(
        ((r["low"], r["rows"]) for r in counted.groupBy(step.alias("step")).agg(
            F.min("n").alias("low"), F.count("*").alias("rows")
        ).collect()),
        reverse=True,
    )
    rows, floor = 0, None
    for low, more in steps:
        rows += more
        if rows > head:
            break
        floor = low
    return floor if floor is not None else 1 << 62


def _hash_ids(words: DataFrame, seed: int) -> DataFrame:
    """``words`` with a hashed ``id`` of (lang, word), above all ranks."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in source:
            pairs = zip(part["lang"].to_pylist(), part["word"].to_pylist(), strict=True)
            ids = [hashed_id(lang, word.encode(), seed) for lang, word in pairs]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.int64())], ["lang", "word", "n", "id"])

    return words.select("lang", "word", "n").mapInArrow(batches, "lang string, word string, n long, id long")


def hashed_id(lang: str, word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word, seed) >> 2 | 1 << 62


def _unique_seed(tail: DataFrame) -> int:
    """The first seed whose hashes tell all words of ``tail`` apart."""
    seed = 0
    while _hash_ids(tail, seed).groupBy("id").agg(F.count("*").alias("words")).filter("words > 1").take(1):
        seed += 1
    return seed


def packed_ids(ids: np.ndarray) -> bytes:
    """Longs, squeezed in halves: those of ranks are all alike."""
    return squeezed(np.concatenate([ids & 0xFFFFFFFF, ids >> 32]))


def unpacked_ids(data: bytes) -> np.ndarray:
    low, high = unsqueezed(data).reshape(2, -1)
    return high << 32 | low


def id_runs(df: DataFrame, ranks: dict[str, dict[bytes, int]], rare: Callable | None) -> DataFrame:
    """The texts as runs of ``ids`` (packed), ``BREAK`` between pieces and for words without an id."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for langs, bodies in slices(source):
            for lang, text in zip(langs, bodies, strict=True):
                found = tokens(text)
                known = ranks.get(lang, {})
                if rare:
                    ids = [known.get(w) if w in known else rare(lang, w) if w != b"." else BREAK for w in found]
                else:
                    ids = [known.get(w, BREAK) for w in found]
                ids.append(BREAK)
                waiting.append(np.array(ids, np.int64))
                size += len(ids)
                if size >= HELD_IDS:
                    yield _run(waiting)
                    waiting, size = [], 0
        if waiting:
            yield _run(waiting)

    def _run(waiting: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"ids": pa.array([packed_ids(np.concatenate(waiting))], pa.binary())})

    return _rows(df).mapInArrow(batches, "ids binary")


# ---------------------------------------------------------------- sieves and heads


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def names(columns: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """A hash of every row of ids."""
    total = np.full(len(columns[0]), seed, _U)
    for column in columns:
        total = _mixed(total + column.view(_U) + _U(0x9E3779B97F4A7C15))
    return total


def _bits(found: np.ndarray) -> np.ndarray:
    return (found % _U(SIEVE_BITS)).astype(np.int64)


def sieve(phrases: DataFrame) -> np.ndarray:
    """A bitmap that has a bit for every row of ``phrases`` (``words``, an array of ids)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(SIEVE_BITS, bool)
        for part in source:
            if part.num_rows:
                width = len(part["words"][0])
                rows = part["words"].flatten().to_numpy().reshape(-1, width)
                marks[_bits(names([np.ascontiguousarray(c) for c in rows.T]))] = True
        cells = np.packbits(marks).view("<i8")
        some = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({"cell": some, "marks": cells[some]})

    cells = np.zeros(SIEVE_BITS // 64, "<i8")
    found = phrases.select("words").mapInArrow(batches, "cell long, marks long")
    for row in found.groupBy("cell").agg(F.bit_or("marks").alias("marks")).toLocalIterator():
        cells[row["cell"]] = row["marks"]
    return cells.view(np.uint8)


def in_sieve(marks: np.ndarray, found: np.ndarray) -> np.ndarray:
    bits = _bits(found)
    return marks[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8) & 1 > 0


class Head:
    """The ranked phrases of a level: from columns of word ids to ranks.

    Rank ``BREAK`` stands for a phrase that is not frequent, ``TAIL`` for one that may be, beyond the head.
    """

    TAIL = -2

    def __init__(self, words: np.ndarray, marks: np.ndarray | None) -> None:
        columns = [np.ascontiguousarray(c) for c in words.T]
        self.seed = 0
        while len(np.unique(found := names(columns, self.seed))) < len(words):
            self.seed += 1
        self.ranks = np.argsort(found)
        self.found = found[self.ranks]
        self.columns = [c[self.ranks] for c in columns]
        self.marks = marks

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        whole = reduce(np.logical_and, (c >= 0 for c in columns))
        result = np.full(len(whole), BREAK, np.int64)
        at_word = np.flatnonzero(whole)
        some = [c[at_word] for c in columns]
        if len(self.found):
            sought = names(some, self.seed)
            place = np.minimum(np.searchsorted(self.found, sought), len(self.found) - 1)
            hit = self.found[place] == sought
            for mine, theirs in zip(self.columns, some, strict=True):
                hit &= mine[place] == theirs
            result[at_word[hit]] = self.ranks[place[hit]]
        else:
            hit = np.zeros(len(at_word), bool)
        if self.marks is not None:
            maybe = ~hit & in_sieve(self.marks, names(some))
            result[at_word[maybe]] = self.TAIL
        return result


# ---------------------------------------------------------------- counting


def tile_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes (first rank << ``HEAD_POWER`` | second rank) and how often each is there."""
    first, second = codes >> HEAD_POWER, codes & (HEAD - 1)
    across = HEAD >> TILE_POWER
    tile = ((first >> TILE_POWER) * across + (second >> TILE_POWER)).astype(np.uint16)
    order = np.argsort(tile, kind="stable")  # 16 bits: a radix sort
    codes = codes[order]
    sizes = np.bincount(tile, minlength=across * across)
    ends = np.cumsum(sizes)
    sparse = np.ones(len(codes), bool)
    found, counts = [], []
    for t in np.flatnonzero(sizes >= DENSE):
        here = slice(ends[t] - sizes[t], ends[t])
        sparse[here] = False
        inside = codes[here]
        local = (inside >> HEAD_POWER & TILE - 1) << TILE_POWER | inside & TILE - 1
        table = np.bincount(local, minlength=TILE * TILE)
        some = np.flatnonzero(table)
        row, column = t // across * TILE + (some >> TILE_POWER), t % across * TILE + (some & TILE - 1)
        found.append(row << HEAD_POWER | column)
        counts.append(table[some])
    rest = np.sort(codes[sparse])
    starts = np.flatnonzero(np.diff(rest, prepend=-1))
    found.append(rest[starts])
    counts.append(np.diff(starts, append=len(rest)))
    return np.concatenate(found), np.concatenate(counts)


def coordinate_counts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a matrix, sorted, and how often each is there."""
    rows = rows[np.lexsort(rows.T[::-1])]
    starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.zeros(0, np.int64)
    return rows[starts], np.diff(starts, append=len(rows))


def grams(ids: np.ndarray, size: int, head: Head | None, limit: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the phrases of ``size`` ids whose rank and last word are in the heads, and the ids of others.

    ``head`` ranks the phrases one word shorter; of single words the ids below ``limit`` are ranks.
    """
    n = max(0, len(ids) - size + 1)
    if head is None:
        before = behind = ids
        before, behind = before[:n], behind[1 : n + 1]
        whole = (before >= 0) & (behind >= 0)
        before = np.where(before < limit, before, Head.TAIL)
    else:
        ranks = head.find([ids[k : len(ids) - size + 2 + k] for k in range(size - 1)])
        before, behind = ranks[:n], ranks[1 : n + 1]
        whole = (before != BREAK) & (behind != BREAK)
    last = ids[size - 1 :][:n]
    direct = whole & (before >= 0) & (last < limit)
    other = np.flatnonzero(whole & ~direct)
    rows = np.stack([ids[other + k] for k in range(size)], axis=1)
    return before[direct] << HEAD_POWER | last[direct], rows


def gram_counts(runs: DataFrame, size: int, head: Head | None, limit: int = HEAD) -> DataFrame:
    """``code`` or ``words``, and ``n``: partial counts of the phrases of ``size`` ids."""

    def emit(codes: list[np.ndarray], rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names_ = ["code", "words", "n"]
        found, n = tile_counts(np.concatenate(codes))
        for at in range(0, len(found), SENT_ROWS):
            some = pa.array(found[at : at + SENT_ROWS])
            none = pa.nulls(len(some), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([some, none, pa.array(n[at : at + SENT_ROWS])], names_)
        words, n = coordinate_counts(np.concatenate(rows))
        for at in range(0, len(words), SENT_ROWS):
            some = words[at : at + SENT_ROWS]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(some.reshape(-1)), size).cast(pa.list_(pa.int64()))
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([none, lists, pa.array(n[at : at + SENT_ROWS])], names_)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, rows, held = [], [], 0
        for part in source:
            for data in part["ids"]:
                direct, other = grams(unpacked_ids(data.as_py()), size, head, limit)
                codes.append(direct)
                rows.append(other)
                held += len(direct) + len(other) * size
                if held >= HELD_GRAMS:
                    yield from emit(codes, rows)
                    codes, rows, held = [], [], 0
        if codes:
            yield from emit(codes, rows)

    return runs.mapInArrow(batches, "code long, words array<long>, n long")


def _head_words(phrases: DataFrame, size: int, head: int) -> tuple[np.ndarray, np.ndarray | None, DataFrame]:
    """The ranked phrases as rows of ids, a sieve of the others if there are any, and ``rank, words``."""
    floor = head_floor(phrases, head)
    first = phrases.filter(F.col("n") >= floor).toArrow()
    words = first["words"].combine_chunks().flatten().to_numpy().reshape(-1, size)
    order = np.lexsort((*words.T[::-1], -first["n"].to_numpy()))
    words = np.ascontiguousarray(words[order])
    rest = phrases.filter(F.col("n") < floor)
    marks = sieve(rest) if rest.take(1) else None
    table = pa.table(
        {
            "rank": pa.array(np.arange(len(words))),
            "before": pa.FixedSizeListArray.from_arrays(pa.array(words.reshape(-1)), size).cast(pa.list_(pa.int64())),
        }
    )
    return words, marks, phrases.sparkSession.createDataFrame(table, "rank long, before array<long>")


# ---------------------------------------------------------------- the phrases


class Counts:
    """Tables of frequent words (``id, lang, word, n``) and phrases (``words, n``), and the totals by lang."""

    def __init__(self, df: DataFrame, folder: str, least: int = LEAST, head: int = HEAD) -> None:
        self.spark: SparkSession = df.sparkSession
        self.folder, self.least, self.head = folder, least, head
        every = self.staged("words", word_counts(df))
        self.totals = every.filter("word is null").select("lang", F.col("n").alias("total"))
        every = every.filter("word is not null")
        frequent = every.filter(F.col("n") >= least)
        floor = max(least, head_floor(frequent, head))
        order = [("n", "descending"), ("lang", "ascending"), ("word", "ascending")]
        first = frequent.filter(F.col("n") >= floor).toArrow().sort_by(order)  # at most HEAD rows
        ranks: dict[str, dict[bytes, int]] = {}
        pairs = zip(first["lang"].to_pylist(), first["word"].cast("binary").to_pylist(), strict=True)
        for rank, (lang, word) in enumerate(pairs):
            ranks.setdefault(lang, {})[word] = rank
        table = first.append_column("id", pa.array(np.arange(len(first))))
        self.head_words = self.staged(
            "head", self.spark.createDataFrame(table, "lang string, word string, n long, id long")
        )
        tail = frequent.filter(F.col("n") < floor)
        rare = None
        self.tail_words = None
        if tail.take(1):
            seed = _unique_seed(every.filter(F.col("n") < floor))
            self.tail_words = self.staged("tail", _hash_ids(tail, seed).select("id", "lang", "word", "n"))
            rare = _rare(seed, sieve(self.tail_words.select(F.array("id").alias("words"))))
        runs = self.staged("runs", id_runs(df, ranks, rare))
        self.phrases: list[DataFrame] = []
        known, prefixes = None, None
        for size in range(2, LONGEST + 1):
            if size > 2:
                words, marks, prefixes = _head_words(self.phrases[-1], size - 1, head)
                known = Head(words, marks)
            counted = (
                gram_counts(runs, size, known, head)
                .groupBy("code", "words")
                .agg(F.sum("n").alias("n"))
                .filter(F.col("n") >= least)
            )
            self.phrases.append(self.staged(f"phrases{size}", _spelled(counted, prefixes)))

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def candidates(self) -> DataFrame:
        """``words, a`` of all phrases."""
        return reduce(DataFrame.union, self.phrases).withColumnRenamed("n", "a")

    def with_count(self, df: DataFrame, part: str, name: str) -> DataFrame:
        """``df`` with the count ``name`` of the phrase in its column ``part``, and the lang of a single word."""
        first = F.element_at(part, 1)
        in_head = (F.size(part) == 1) & (first < self.head)
        words = F.broadcast(self.head_words.select("id", F.col("n").alias(name), F.col("lang").alias(f"{name}_lang")))
        done = df.filter(in_head).join(words, first == F.col("id")).drop("id")
        known = [p.select(F.col("words").alias("part"), F.col("n").alias(name), F.lit(None).cast("string").alias(f"{name}_lang")) for p in self.phrases[:-1]]
        if self.tail_words is not None:
            known.append(
                self.tail_words.select(F.array("id").alias("part"), F.col("n").alias(name), F.col("lang").alias(f"{name}_lang"))
            )
        others = reduce(DataFrame.union, known)
        return done.unionByName(df.filter(~in_head).join(others, F.col(part) == F.col("part")).drop("part"))

    def with_word(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``word`` of its column ``id``."""
        done = df.join(F.broadcast(self.head_words.select("id", "word")), "id")
        if self.tail_words is None:
            return done
        return done.unionByName(df.filter(F.col("id") >= self.head).join(self.tail_words.select("id", "word"), "id"))


def _rare(seed: int, marks: np.ndarray) -> Callable[[str, bytes], int]:
    def find(lang: str, word: bytes) -> int:
        number = hashed_id(lang, word, seed)
        return number if in_sieve(marks, names([np.array([number], np.int64)]))[0] else BREAK

    return find


def _spelled(counted: DataFrame, prefixes: DataFrame | None) -> DataFrame:
    """``words, n``: codes become the words of their rank and the last word."""
    rank, last = F.shiftright("code", HEAD_POWER), F.col("code").bitwiseAND(F.lit(HEAD - 1))
    coded = counted.filter("code is not null")
    if prefixes is None:
        spelled = coded.select(F.array(rank, last).alias("words"), "n")
    else:
        spelled = (
            coded.withColumn("rank", rank)
            .join(F.broadcast(prefixes), "rank")
            .select(F.concat("before", F.array(last)).alias("words"), "n")
        )
    return spelled.union(counted.filter("code is null").select("words", "n"))


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _scored(counts: Counts) -> DataFrame:
    """``words, lang, a, l, r, score`` of every candidate, by its least cut."""
    cuts = counts.candidates().withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    parts = cuts.select(
        "words",
        "a",
        "k",
        F.slice("words", F.lit(1), F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    both = counts.with_count(counts.with_count(parts, "left", "l"), "right", "r")
    scored = both.withColumn(
        "score", F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    )
    least = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    return scored.groupBy("words").agg(F.max("l_lang").alias("lang"), F.max("a").alias("a"), least).select(
        "words", "lang", "a", "cut.l", "cut.r", "cut.score"
    )


def _covered(counts: Counts) -> DataFrame:
    """``words, around``: the most occurrences of a longer phrase around a phrase."""
    inner = [
        phrases.select(
            F.explode(
                F.array(
                    *(
                        F.slice("words", start, length)
                        for length in range(2, size)
                        for start in range(1, size - length + 2)
                    )
                )
            ).alias("words"),
            "n",
        )
        for size, phrases in enumerate(counts.phrases[1:], 3)
    ]
    return reduce(DataFrame.union, inner).groupBy("words").agg(F.max("n").alias("around"))


def _step() -> Column:
    """Scores by steps of a thousandth of the highest there can be."""
    return F.floor(F.col("score") / (SCALE // 2000))


def _least_steps(scored: DataFrame, top: int) -> DataFrame:
    """``lang, least``: the step of scores from which on each lang has its best ``top``, all told.

    A thousand counts a lang settle it, so that no more than about the best have to be put in order.
    """
    counted = scored.groupBy("lang", _step().alias("step")).agg(F.count("*").alias("n"))
    higher = Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    needed = counted.withColumn("higher", F.coalesce(F.sum("n").over(higher), F.lit(0))).filter(F.col("higher") < top)
    return needed.groupBy("lang").agg(F.min("step").alias("least"))


def collocations(df: DataFrame, least: int = LEAST, top: int = TOP, head: int = HEAD) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best ``top`` phrases of every lang of ``lang, text``."""
    with workspace(df.sparkSession) as folder:
        counts = Counts(df, folder, least, head)
        free = counts.staged(
            "free",
            _scored(counts)
            .join(_covered(counts), "words", "left")
            .filter(F.col("around").isNull() | (_exact("around") * 100 < _exact("a") * COVERED_PERCENT))
            .drop("around"),
        )
        order = [F.desc("score"), F.desc("a")]
        best = (
            free.join(_least_steps(free, top), "lang")
            .filter(_step() >= F.col("least"))
            .drop("least")
            .withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
            .filter(F.col("place") <= top)
        )
        spelled = counts.with_word(best.select("*", F.posexplode("words").alias("at", "id")))
        parts = F.sort_array(F.collect_list(F.struct("at", "word")))
        phrases = spelled.groupBy("words", "lang", "a", "l", "r", "score").agg(
            F.array_join(F.transform(parts, lambda p: p["word"]), " ").alias("phrase")
        )
        last = Window.partitionBy("lang").orderBy(*order, "phrase")
        ranked = phrases.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
        return checkpointed(
            ranked.join(counts.totals, "lang").select(
                "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
            )
        )
