"""Near-duplicate documents by MinHash bands, odd sketches and an exact test.

A document is the set of its five-word shingles, in lower case (A to Z only); with fewer words, its
whole sequence of words is the one shingle. Documents are linked if the similarity of their sets is
at least ``PERCENT`` hundredths, or as many as the caller asks for, from ``LEAST_PERCENT`` on; groups
are the components of the links.

1. One pass makes, for every text, MinHash samples (352 at 85 hundredths), their band keys (44), and an
   odd sketch: every sample flips one of 1,024 bits. Equal sets are found by a 128-bit digest and become one node.
2. Nodes that share a band are candidates (``linking``). Bands are laid out for the threshold: a pair
   at it shares none of its bands once in a million (``MISSED``); the hubs of a group give it further chances.
3. The XOR of two odd sketches has as many bits as the samples' symmetric difference, but for
   collisions, which the estimate takes off. Candidates whose count is beyond that of a pair at the
   threshold by six standard deviations are dropped.
4. The rest are confirmed on their full sets, which are made again for candidates only.
5. Buckets whose members still belong to several groups, such as many near copies that are just not
   near enough, are compared in blocks of at most some ``BLOCK_ROWS`` members: a task compares two
   blocks, sketches first, then sets, and returns the few links that connect them, not the pairs.

Shingles are compared by 64-bit hashes. A null or empty text, or one of blanks, is linked with
nothing. Rows that repeat an id and a text are one document; different texts under one id, or
without one, are documents of their own. A group's id is its least ``doc_id``.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpipe.llm.linking import grouped, shared_members
from riskpipe.llm.shared import checkpointed, map_columns, texts

SHINGLE_WORDS = 5
PERCENT = 85
LEAST_PERCENT = 80
#: Samples of a band for thresholds from ``PERCENT`` on, and below; pairs at the threshold that no band finds.
BAND_ROWS, WIDE_BAND_ROWS = 8, 7
MISSED = 1e-6
SKETCH_BITS = 1024
#: Words a Python worker remembers the hashes of.
CACHED_WORDS = 300_000
CHUNK_SHINGLES = 1024
#: Members of a block, about; and shingles whose common use is counted at once.
BLOCK_ROWS = 1024
CHUNK_COLUMNS = 4096

_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value


def layout(percent: int = PERCENT) -> tuple[int, int]:
    """Bands, and samples of each, that find a pair at the threshold; all of ``PERCENT`` and more share one."""
    rows = BAND_ROWS if percent >= PERCENT else WIDE_BAND_ROWS
    found = (min(percent, PERCENT) / 100) ** rows
    return math.ceil(math.log(MISSED) / math.log(1 - found)), rows


def n_samples(percent: int = PERCENT) -> int:
    bands, rows = layout(percent)
    return bands * rows


@functools.cache
def _constants(percent: int = PERCENT) -> dict[str, np.ndarray]:
    bands, rows = layout(percent)
    rng = np.random.default_rng(85)
    draw = lambda n: rng.integers(0, 1 << 63, n, np.uint64) * _U(2) + _U(1)
    return {
        "places": draw(SHINGLE_WORDS),
        "lengths": draw(SHINGLE_WORDS + 1),
        "times": draw(bands * rows),
        "plus": draw(bands * rows),
        "rows": draw(rows),
        "bands": draw(bands),
        "flips": draw(bands * rows),
    }


_word_hashes = functools.cache(_WordHashes)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingle_set(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    known, fixed = _word_hashes(), _constants()
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, _U)
    hashes = np.fromiter((known[w] for w in found), _U, len(found))
    width = min(len(found), SHINGLE_WORDS)
    n = len(found) - width + 1
    total = np.full(n, fixed["lengths"][width])
    for k in range(width):
        total += hashes[k : k + n] * fixed["places"][k]
    return np.unique(_mixed(total))


def minhashes(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    fixed = _constants(percent)
    least = np.full(n_samples(percent), np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), CHUNK_SHINGLES):
        part = shingles[at : at + CHUNK_SHINGLES, None] * fixed["times"] + fixed["plus"]
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(samples: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    fixed = _constants(percent)
    keys = (samples.reshape(layout(percent)) * fixed["rows"]).sum(axis=1, dtype=_U)
    return _mixed(keys + fixed["bands"]).view(np.int64)


def odd_sketch(samples: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Bits that an odd number of samples falls on, as longs."""
    places = _mixed(samples + _constants(percent)["flips"]) >> _U(64 - int(math.log2(SKETCH_BITS)))
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_flips(percent: int = PERCENT) -> int:
    """Bits of an XOR of sketches beyond which a pair is less like than ``percent`` hundredths."""
    unlike, samples = 1 - percent / 100, n_samples(percent)
    apart = 2 * samples * unlike
    slope = math.exp(-2 * apart / SKETCH_BITS)
    expected = SKETCH_BITS / 2 * (1 - slope)
    variance = (slope * 2) ** 2 * samples * unlike * (1 - unlike) + expected
    return math.ceil(expected + 6 * math.sqrt(variance))


def estimated(flips: int) -> float:
    """The similarity that a count of differing bits stands for, of sketches laid out for ``PERCENT``."""
    return 1 + SKETCH_BITS / (4 * n_samples()) * math.log(1 - 2 * flips / SKETCH_BITS)


def signatures(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``key`` (doc_id and a hash of the text), ``n_shingles, set_id, bands, sketch`` of every row."""

    def rows(keys: list, bodies: list[str]) -> list[tuple]:
        done = []
        for key, body in zip(keys, bodies, strict=True):
            shingles = shingle_set(body)
            if not len(shingles):
                done.append((key, 0, None, None, None))
                continue
            samples = minhashes(shingles, percent)
            digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()
            bands, sketch = band_keys(samples, percent), odd_sketch(samples, percent)
            done.append((key, len(shingles), digest, bands, sketch))
        return done

    return map_columns(
        _keyed(df),
        rows,
        "key",
        "n_shingles long, set_id string, bands array<long>, sketch array<long>",
    )


def _keyed(df: DataFrame) -> DataFrame:
    return texts(df).select(F.struct("doc_id", F.xxhash64("text").alias("tie")).alias("key"), "text")


def _flips(one: Column, other: Column) -> Column:
    return F.aggregate(
        F.zip_with(one, other, lambda a, b: F.bit_count(a.bitwiseXOR(b))),
        F.lit(0),
        lambda total, n: total + n,
    )


def _rooted(df: DataFrame, percent: int) -> DataFrame:
    """``key, n_shingles`` of every row, and the ``root`` of its group, null without shingles.

    ``percent`` may be ``LEAST_PERCENT`` or more: the bands are laid out for it.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"the bands find similarities from {LEAST_PERCENT} hundredths on")
    signed = checkpointed(signatures(df, percent).withColumn("row", F.monotonically_increasing_id()))
    first = signed.filter("n_shingles > 0").groupBy("set_id").agg(F.min("row").alias("node"))
    nodes = signed.join(first.select(F.col("node").alias("row")), "row", "left_semi")
    members = checkpointed(
        shared_members(
            nodes.select(F.explode("bands").alias("bucket"), F.col("row").alias("node")).distinct()
        )
    )
    chosen = members.select("node").distinct()
    known = checkpointed(
        signed.join(chosen, F.col("row") == F.col("node")).select("node", "key", "n_shingles", "sketch")
    )
    sets = checkpointed(_full_sets(df, known))

    def test(pairs: DataFrame) -> DataFrame:
        a = known.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("s"))
        b = known.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("t"))
        sketched = (
            pairs.join(a, "a")
            .join(b, "b")
            .filter((100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
            .filter(_flips(F.col("s"), F.col("t")) <= most_flips(percent))
            .select("a", "b")
        )
        x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        return (
            sketched.join(x, "a")
            .join(y, "b")
            .withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both")))
            .select("a", "b")
        )

    def last(mixed: DataFrame) -> DataFrame:
        return _block_links(mixed, known.select("node", "sketch").join(sets, "node"), percent)

    roots = grouped(members, test, last)
    of_set = first.join(roots, "node", "left").select(
        "set_id", F.coalesce("root", "node").alias("root")
    )
    return signed.select("key", "n_shingles", "set_id").join(of_set, "set_id", "left").drop("set_id")


def classes(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    rooted = _rooted(df, percent)
    least = rooted.filter("n_shingles > 0").groupBy("root").agg(F.min("key.doc_id").alias("least"))
    return rooted.join(least, "root", "left").select(
        "key.doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("key.doc_id")).alias(
            "component_id"
        ),
    )


def _block_links(mixed: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links that connect whatever links within a bucket of ``mixed`` connect."""
    sizes = mixed.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    block, other = F.col("block"), F.col("other")
    rows = (
        mixed.join(sizes, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node", "bucket"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.struct("bucket", F.least(block, other).alias("i"), F.greatest(block, other).alias("j")).alias(
                "pair"
            ),
            "node",
            "root",
            "block",
        )
        .join(known, "node")
    )
    flips = most_flips(percent)

    def compare(rows: pa.Table) -> pa.Table:
        found = block_links(
            rows["node"].to_numpy(),
            rows["root"].to_numpy(),
            rows["block"].to_numpy(),
            np.array(rows["sketch"].to_pylist(), np.int64),
            [np.asarray(s.values) for s in rows["shingles"]],
            percent,
            flips,
        )
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
        )

    return rows.groupBy("pair").applyInArrow(compare, "a long, b long").distinct()


def block_links(
    nodes: np.ndarray,
    roots: np.ndarray,
    blocks: np.ndarray,
    sketches: np.ndarray,
    sets: list[np.ndarray],
    percent: int,
    flips: int,
) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks, or within one."""
    one = blocks == blocks.min()
    left = np.flatnonzero(one)
    right = left if one.all() else np.flatnonzero(~one)
    sketches = sketches.view(_U)  # of signed numbers numpy would count the bits of the size
    apart = np.zeros((len(left), len(right)), np.int32)
    for k in range(sketches.shape[1]):
        apart += np.bitwise_count(sketches[left, None, k] ^ sketches[None, right, k])
    sizes = np.array([len(s) for s in sets], np.int64)
    most = np.maximum(sizes[left, None], sizes[None, right])
    near = (apart <= flips) & (roots[left, None] != roots[None, right])
    near &= 100 * np.minimum(sizes[left, None], sizes[None, right]) >= percent * most
    if right is left:
        near &= np.triu(np.ones_like(near), 1)
    if not near.any():
        return []
    left, right, near = left[near.any(1)], right[near.any(0)], near[near.any(1)][:, near.any(0)]
    both = common(sets, left, right)
    linked = near & (
        100 * both >= percent * (sizes[left, None] + sizes[None, right] - both)
    )
    group = {int(r): int(r) for r in roots}

    def find(r: int) -> int:
        while group[r] != r:
            group[r] = r = group[group[r]]
        return r

    forest = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = find(int(roots[left[i]])), find(int(roots[right[j]]))
        if a != b:
            group[a] = b
            forest.append(tuple(sorted((int(nodes[left[i]]), int(nodes[right[j]])))))
    return forest


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sizes of all intersections, from the shingles that stand on both sides."""
    flat = [np.concatenate([sets[i] for i in side]) for side in (left, right)]
    owner = [np.repeat(np.arange(len(s)), [len(sets[i]) for i in s]) for s in (left, right)]
    shared = np.intersect1d(*flat)
    places = [np.searchsorted(shared, f) for f in flat]
    both = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(shared), CHUNK_COLUMNS):
        has = []
        for f, o, p, side in zip(flat, owner, places, (left, right), strict=True):
            inside = (p >= at) & (p < min(at + CHUNK_COLUMNS, len(shared)))
            inside[inside] = shared[p[inside]] == f[inside]
            matrix = np.zeros((len(side), CHUNK_COLUMNS), np.float32)
            matrix[o[inside], p[inside] - at] = 1
            has.append(matrix)
        both += (has[0] @ has[1].T).astype(np.int64)
    return both


def _full_sets(df: DataFrame, known: DataFrame) -> DataFrame:
    """``node, shingles`` of the known nodes, from their texts."""
    bodies = _keyed(df).join(known.select("key", "node"), "key").select("node", "text")
    return map_columns(
        bodies.dropDuplicates(["node"]),
        lambda keys, rows: [
            (k, shingle_set(t).view(np.int64)) for k, t in zip(keys, rows, strict=True)
        ],
        "node",
        "shingles array<long>",
    )


def near_duplicates(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``classes`` with ``kept``, true for the document that its group is named after."""
    return classes(df, percent).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group, with ``df``'s columns; rows without shingles all stay.

    The row kept is the one whose id names the group. If different texts share that id, or the group
    has no id, the text with the least hash stays; of repeated rows one stays.
    """
    rooted = checkpointed(_rooted(df, percent).filter("n_shingles > 0"))
    first = F.min_by("key", F.struct(F.col("key.doc_id").isNull(), "key")).alias("stays")
    keepers = rooted.groupBy("root").agg(first)
    verdicts = (
        rooted.join(keepers, "root").select("key", (F.col("key") == F.col("stays")).alias("stay")).distinct()
    )
    rows = df.select(
        F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).alias("key"),
        F.struct(*(df[c] for c in df.columns)).alias("row"),
    )
    copies = Window.partitionBy("key").orderBy("key")
    left = (
        rows.join(verdicts, "key", "left")
        .filter(F.coalesce("stay", F.lit(True)))
        .withColumn("copy", F.row_number().over(copies))
        .filter("copy = 1 or stay is null")
    )
    return left.select("row.*")
