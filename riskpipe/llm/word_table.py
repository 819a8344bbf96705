"""Encoding and decoding with a word-level BPE by a table of distinct words.

The tokenizer drops white space and never joins across it, so a text's ids are those of its
blank-separated words in turn.

1. One pass splits texts into words and makes chunks: the documents that a task meets in turn, up to
   ``CHUNK_WORDS`` words. A chunk holds its distinct words, the more frequent first, and for every
   document the numbers of its words in that list. It is written once, so all uses below see the same,
   bucketed by chunk, so that the numbers are never shuffled.
2. Words are dealt into shares by a hash, as many shares as there are ``SHARE_BYTES`` of text. A share is
   one group of a task: the words that any chunk has in it, and where. Each distinct word is encoded
   once, and its ids go back to all its places, by chunk. A share holds no word more often than there
   are chunks, however often it stands in the texts.
3. The ids are joined back by chunk and number, and the numbers of a document make its ids in order.
4. Decoding joins ids to the pieces of the vocabulary (``pieces``, a table as long as the vocabulary),
   keyed by id, and joins the pieces of a document by a blank, as the library does for a model without
   a decoder.

A null text is empty, and has no ids. Rows are never merged: repeated rows and ids stay, and other
columns have no part in it. A word that the tokenizer drops whole has no ids.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType
from tokenizers import Tokenizer
from xxhash import xxh3_64_intdigest

from riskpipe.llm.packing import TOKENIZER
from riskpipe.llm.shared import checkpointed, slices, texts, workspace

__all__ = ["TOKENIZER", "decoded", "encoded", "round_trip", "token_digests"]

#: Words of a chunk, and bytes of its texts, that close it; one text is never cut.
CHUNK_WORDS, CHUNK_BYTES = 1 << 21, 1 << 24
#: Bytes of text for each share of the words, the least number of shares, and documents whose ids are
#: put together at once.
SHARE_BYTES, LEAST_SHARES, SLICE_DOCS = 1 << 23, 64, 128
#: Words that the library encodes at once.
SLICE_WORDS = 1 << 12


# ---------------------------------------------------------------- numbers as bytes


def squeezed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed byte place by byte place."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of ranges in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


# ---------------------------------------------------------------- chunks


class _Chunk:
    def __init__(self) -> None:
        self.keys: list = []
        self.lengths: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.words = self.bytes = 0

    def add(self, key: object, text: str) -> None:
        data = text.encode()
        found, numbers = data.split(), self.numbers
        for word in set(found).difference(numbers):
            numbers[word] = len(numbers)
        self.keys.append(key)
        self.lengths.append(len(found))
        self.parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        self.words += len(found)
        self.bytes += len(data)

    def row(self, name: int, shares: int) -> tuple:
        """(name, keys, lengths, numbers, shares of words); numbers go by falling frequency, then spelling."""
        body = np.concatenate(self.parts)
        words = sorted(self.numbers)
        old = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        counts = np.bincount(body, minlength=len(words))[old]
        order = np.argsort(-counts, kind="stable")
        number = np.empty(len(words), np.int64)
        number[old[order]] = np.arange(len(words))
        words = [words[i] for i in order.tolist()]
        return name, self.keys, self.lengths, squeezed(number[body]), list(_shared_out(words, shares))


def _shared_out(words: list[bytes], shares: int) -> Iterator[dict]:
    """The words of every share, by number, and the steps from number to number."""
    share = np.fromiter((xxh3_64_intdigest(w) % shares for w in words), np.int64, len(words))
    order = np.argsort(share, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(share[order])) + 1) if len(words) else ():
        listed = zstandard.ZstdCompressor(level=3).compress(b"\n".join([words[i] for i in some.tolist()]))
        yield {"share": int(share[some[0]]), "steps": squeezed(np.diff(some, prepend=0)), "words": listed}


def chunks(df: DataFrame, shares: int) -> DataFrame:
    """``chunk``, its documents' ``keys`` and ``lengths``, the ``body`` of word numbers and the words' ``shares``."""
    rows = texts(df)
    schema = StructType(
        [
            *StructType.fromDDL("chunk long"),
            StructField("keys", ArrayType(rows.schema["doc_id"].dataType)),
            *StructType.fromDDL(
                "lengths array<int>, body binary, shares array<struct<share: int, steps: binary, words: binary>>"
            ),
        ]
    )
    target = to_arrow_schema(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(chunk: _Chunk) -> pa.RecordBatch:
            row = chunk.row((TaskContext.get().partitionId() << 32) + done, shares)
            columns = [pa.array([value], f.type) for value, f in zip(row, target, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=target)

        chunk, done = _Chunk(), 0
        for keys, bodies in slices(source):
            for key, text in zip(keys, bodies, strict=True):
                chunk.add(key, text)
                if chunk.words >= CHUNK_WORDS or chunk.bytes >= CHUNK_BYTES:
                    yield batch(chunk)
                    chunk, done = _Chunk(), done + 1
        if chunk.keys:
            yield batch(chunk)

    return rows.mapInArrow(batches, schema)


# ---------------------------------------------------------------- the word table


@functools.cache
def _coder(tokenizer: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(tokenizer)


def encoded_words(words: list[bytes], tokenizer: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """Every word with its ids."""
    for at in range(0, len(words), SLICE_WORDS):
        some = words[at : at + SLICE_WORDS]
        found = _coder(tokenizer).encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
        yield from zip(some, (np.array(one.ids, np.uint32) for one in found), strict=True)


def word_ids(words: DataFrame, tokenizer: str) -> DataFrame:
    """``chunk, steps, ids`` from the ``chunk, share, steps, words`` of chunks.

    ``ids`` has how many ids each word has, then the ids, squeezed; the words are those of ``steps``.
    """

    def encode(share: pa.Table) -> pa.Table:
        seen, parts = {}, []
        for data in share["words"].to_pylist():
            listed = zstandard.ZstdDecompressor().decompress(data).split(b"\n")
            seen.update(encoded_words(list(set(listed).difference(seen)), tokenizer))
            found = [seen[word] for word in listed]
            parts.append(squeezed(np.concatenate([[len(ids) for ids in found], *found])))
        return pa.table({"chunk": share["chunk"], "steps": share["steps"], "ids": pa.array(parts, pa.binary())})

    return words.groupBy("share").applyInArrow(encode, "chunk long, steps binary, ids binary")


@functools.cache
def pieces(tokenizer: str) -> list[bytes]:
    """The piece of every id, by id."""
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        table[number] = piece.encode()
    return table


def joined_pieces(ids: np.ndarray, tokenizer: str) -> bytes:
    """The decoded text of ids."""
    return b" ".join(map(pieces(tokenizer).__getitem__, ids.tolist()))


def _documents(bodies: pa.Table, parts: pa.Table) -> Iterator[tuple[object, np.ndarray]]:
    """The key and the ids of every document of a chunk."""
    numbers = [np.cumsum(unsqueezed(data)) for data in parts["steps"].to_pylist()]
    found = [unsqueezed(data) for data in parts["ids"].to_pylist()]
    flat = np.concatenate([f[len(n) :] for n, f in zip(numbers, found, strict=True)] or [np.zeros(0, np.int64)])
    starts, lengths = (np.zeros(sum(map(len, numbers)), np.int64) for _ in range(2))
    if found:
        place = np.concatenate(numbers)
        many = np.concatenate([f[: len(n)] for n, f in zip(numbers, found, strict=True)])
        lengths[place] = many
        starts[place] = np.cumsum(many) - many
    for row in bodies.to_pylist():
        body = unsqueezed(row["body"])
        ends = np.cumsum(row["lengths"])
        for first in range(0, len(ends), SLICE_DOCS):
            some = ends[first : first + SLICE_DOCS]
            begin = ends[first - 1] if first else 0
            words = body[begin : some[-1]]
            ids = flat[ranges(starts[words], lengths[words])]
            before = np.concatenate([[0], np.cumsum(lengths[words])])
            for key, ids_of in zip(
                row["keys"][first : first + SLICE_DOCS], np.split(ids, before[some - begin][:-1]), strict=True
            ):
                yield key, ids_of


def _assembled(df: DataFrame, tokenizer: str, folder: str, decode: bool) -> DataFrame:
    spark = df.sparkSession
    size = texts(df).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(LEAST_SHARES, size // SHARE_BYTES)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"chunks_{uuid.uuid4().hex}"
    (
        chunks(df, shares)
        .write.option("compression", "zstd")
        .option("path", f"{folder}/chunks")
        .bucketBy(buckets, "chunk")
        .saveAsTable(name)
    )
    table = spark.table(name)
    words = table.select("chunk", F.inline("shares"))
    key = table.schema["keys"].dataType.elementType
    schema = StructType([StructField("doc_id", key), *StructType.fromDDL("ids binary")])
    if decode:
        schema = schema.add("decoded", "binary")
    target = to_arrow_schema(schema)

    def assemble(bodies: pa.Table, parts: pa.Table) -> pa.Table:
        batches, rows = [], _documents(bodies, parts)
        while some := list(islice(rows, SLICE_DOCS)):
            columns = [[key for key, _ in some], [ids.astype("<u4").tobytes() for _, ids in some]]
            if decode:
                columns.append([joined_pieces(ids, tokenizer) for _, ids in some])
            arrays = [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)]
            batches.append(pa.RecordBatch.from_arrays(arrays, schema=target))
        return pa.Table.from_batches(batches, schema=target)

    bodies = table.select("chunk", "keys", "lengths", "body")
    done = (
        bodies.groupBy("chunk")
        .cogroup(word_ids(words, tokenizer).groupBy("chunk"))
        .applyInArrow(assemble, schema)
    )
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are the folder's
    return done


# ---------------------------------------------------------------- interface


def encoded(df: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """``doc_id`` and the ``ids`` of its text (binary, four little-endian bytes an id).

    ``folder`` (see ``workspace``) holds the chunks while the result is used.
    """
    return _assembled(df, tokenizer, folder, decode=False)


def round_trip(df: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """``encoded`` with the text that the ids stand for, as the library would decode them (UTF-8)."""
    return _assembled(df, tokenizer, folder, decode=True)


def decoded(df: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, decoded`` for any table of ``doc_id`` and ``ids``; null ids are none."""
    rows = df.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL("ids binary, decoded binary")])
    target = to_arrow_schema(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts_ = [joined_pieces(np.frombuffer(ids, "<u4"), tokenizer) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts_, pa.binary())], schema=target)

    return rows.mapInArrow(batches, schema)


def token_digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text for every row."""
    with workspace(df.sparkSession) as folder:
        return checkpointed(
            round_trip(df, tokenizer, folder).select(
                "doc_id",
                (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                F.sha2("ids", 256).alias("ids_sha256"),
                F.sha2("decoded", 256).alias("decoded_sha256"),
            )
        )
