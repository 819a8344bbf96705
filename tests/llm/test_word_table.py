import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskpipe.llm import word_table
from riskpipe.llm.shared import workspace

WORDS = public_tokenizers.path(word_table.TOKENIZER)
LIBRARY = Tokenizer.from_file(WORDS)


def digests(rows):
    expected = Counter()
    for r in rows:
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        data = np.array(ids, "<u4").tobytes()
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        expected[
            r["doc_id"], len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        ] += 1
    return expected


@pytest.mark.parametrize("which", ["documents", "edge_docs", "no_docs"])
def test_digests_equal_the_library(request, which):
    docs = request.getfixturevalue(which)
    assert Counter(map(tuple, word_table.token_digests(docs, WORDS).collect())) == digests(docs.collect())


def test_small_chunks_and_parts_change_nothing(spark, documents, monkeypatch):
    # two partitions, many chunks a task: chunk names, numbers and slices must still fit together
    for name, value in (("CHUNK_WORDS", 500), ("LEAST_SHARES", 3), ("SLICE_DOCS", 2)):
        monkeypatch.setattr(word_table, name, value)
    some = documents.filter("doc_id < 60")
    with workspace(spark) as folder:
        rows = word_table.encoded(some.repartition(2), WORDS, folder).collect()
        assert spark.read.parquet(f"{folder}/chunks").count() > 10
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows} == {
        r["doc_id"]: LIBRARY.encode(r["text"], add_special_tokens=False).ids for r in some.collect()
    }


def test_shares_hold_every_word_once_and_come_back_in_place(spark, documents, monkeypatch):
    monkeypatch.setattr(word_table, "CHUNK_WORDS", 2000)
    table = word_table.chunks(documents.filter("doc_id < 40"), 7).cache()
    words = table.select("chunk", F.inline("shares"))
    back = {(r["chunk"], r["steps"], r["ids"]) for r in word_table.word_ids(words, WORDS).collect()}
    sent = words.collect()
    seen = {}
    for row in sent:
        listed = zstandard.ZstdDecompressor().decompress(row["words"]).decode().split("\n")
        assert all(seen.setdefault(w, row["share"]) == row["share"] for w in listed)
        ids = [LIBRARY.encode(w, add_special_tokens=False).ids for w in listed]
        flat = [*map(len, ids), *(i for some in ids for i in some)]
        assert any(
            (chunk, steps) == (row["chunk"], row["steps"]) and word_table.unsqueezed(found).tolist() == flat
            for chunk, steps, found in back
        )
    for chunk in table.select("chunk", "lengths", "body").collect():
        numbers = np.concatenate(
            [np.cumsum(word_table.unsqueezed(r["steps"])) for r in sent if r["chunk"] == chunk["chunk"]]
        )
        assert sorted(numbers) == list(range(len(numbers)))
        body = word_table.unsqueezed(chunk["body"])
        assert len(body) == sum(chunk["lengths"]) and set(body) == set(numbers)
        assert (np.diff(np.bincount(body)) <= 0).all()  # the more frequent first


def test_decoding_any_ids(spark):
    rows = [(1, np.array([320, 1000, 49407, 5], "<u4").tobytes()), (2, None), (None, b"")]
    done = word_table.decoded(spark.createDataFrame(rows, "doc_id long, ids binary"), WORDS).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in done} == {
        1: LIBRARY.decode([320, 1000, 49407, 5], skip_special_tokens=False),
        2: "",
        None: "",
    }


def test_squeezing_is_a_round_trip():
    numbers = np.array([0, 1, 255, 256, 65_536, 2**31, 2**32 - 1])
    assert word_table.unsqueezed(word_table.squeezed(numbers)).tolist() == numbers.tolist()
    assert word_table.unsqueezed(word_table.squeezed(np.zeros(0, np.int64))).tolist() == []


def test_nothing_is_left_in_the_shared_folder_but_the_result(spark, documents):
    import glob

    root = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    word_table.token_digests(documents, WORDS).count()
    assert not glob.glob(f"{root}/tables-*")
