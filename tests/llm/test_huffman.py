"""Coded token files: round trips, optimal lengths, and the query against the tokenizer itself."""

import heapq
import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smoothway.llm import huffman, queries, store

PATHS = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]


def plain_cost(counts, limit):
    """Least total bits over all lengths that make a prefix code; the longest go to the rarest."""
    counts = sorted(counts)
    ways = combinations_with_replacement(range(limit, 0, -1), len(counts))
    return min(sum(c * m for c, m in zip(counts, w, strict=True)) for w in ways if sum(2.0**-m for m in w) <= 1)


def unlimited_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    return cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=2, max_size=9), st.integers(4, 8))
def test_lengths_are_the_best_under_the_limit(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    assert sum(2.0**-m for m in lengths) <= 1
    assert lengths.max() <= limit
    assert sum(int(c) * int(m) for c, m in zip(counts, lengths, strict=True)) == plain_cost(counts, limit)


def test_wide_limit_is_plain_huffman_and_a_tight_one_is_kept():
    counts = np.array([2**k for k in range(30)])
    assert (huffman.code_lengths(counts, 40) * counts).sum() == unlimited_cost(counts.tolist())
    assert huffman.code_lengths(counts, 6).max() == 6
    assert huffman.code_lengths(np.ones(100, dtype=np.int64), 2).max() == 7  # a hundred words don't fit in two bits
    assert huffman.code_lengths(np.array([5])).tolist() == [1]
    assert huffman.code_lengths(np.zeros(0, dtype=np.int64)).tolist() == []


def test_codes_are_canonical():
    book = huffman.Codebook(np.array([7, 3, 5, 9]), np.array([2, 2, 1, 2]) + np.array([1, 0, 0, 1]))
    code, length = book.writer()
    assert {int(i): format(int(code[i]) >> (book.limit - int(length[i])), f"0{length[i]}b") for i in (5, 3, 7, 9)} == {5: "0", 3: "10", 7: "110", 9: "111"}
    with pytest.raises(ValueError, match="prefix"):
        huffman.Codebook(np.arange(3), np.ones(3, dtype=np.int64))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=700), st.sampled_from([1, 3, 64]), st.sampled_from([9, 12, 16]))
def test_round_trip_from_each_checkpoint(ids, step, limit):
    ids = np.array(ids, dtype=np.uint32)
    known, counts = np.unique(np.append(ids, 0), return_counts=True)
    book = huffman.Codebook(known.astype(np.int64), huffman.code_lengths(counts, limit))
    bits, gaps = huffman.encode(ids, book.writer(), book.limit, step)
    assert len(gaps) == -(-len(ids) // step)
    assert len(bits) == -(-gaps.sum() // 8)
    assert huffman.decode(bits, gaps, len(ids), book.reader(), book.limit, step).tolist() == ids.tolist()


def test_spread_out_in_parts(monkeypatch):
    ids = np.arange(5000, dtype=np.uint32) % 37
    book = huffman.Codebook(np.arange(37), huffman.code_lengths(np.arange(1, 38)))
    whole = huffman.encode(ids, book.writer(), book.limit)
    monkeypatch.setattr(huffman, "AT_ONCE", 7)
    assert huffman.encode(ids, book.writer(), book.limit)[0] == whole[0]


def _expected(rows):
    from tokenizers import Tokenizer

    whole, at, out = Tokenizer.from_file(PATHS[0]), 0, []
    for k, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((k, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_query_against_the_tokenizer(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert sorted(map(tuple, queries.op13_token_files(spark, sf_dir).collect())) == _expected(docs)


def test_small_blocks_and_parts_hold_the_same(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(huffman, "PART_BYTES", 1 << 15)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = huffman.tokenized_blocks(docs, *PATHS, block=500)
    folder = huffman.save(raw, store.place(spark, "small"), limit=15, step=8)
    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "block", "start", "doc_ids").orderBy("start").collect()
    assert len({r["part"] for r in blocks}) > 3
    assert [k for r in blocks for k in r["doc_ids"]] == sorted(k for r in blocks for k in r["doc_ids"])
    assert [(r["part"], r["block"]) for r in blocks] == sorted((r["part"], r["block"]) for r in blocks)
    told = huffman.load(spark, folder, keep_ids=True).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in told] == _expected(docs.select("doc_id", "text").orderBy("doc_id").collect())
    assert all(zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in told)


def test_odd_rows(spark):
    rows = [(1, "same row"), (1, "same row"), (1, "other"), (2, None), (3, ""), (None, "first of all"), (4, "long text " * 40_000), (5, "текст \U0001f600  \n x")]
    docs = spark.createDataFrame([(k, t, 3) for k, t in rows], "doc_id long, text string, start int")
    found = huffman.stored(docs, store.place(spark, "odd"), *PATHS).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, 1, 1, 1, 2, 3, 4, 5]
    given = sorted((x for x in rows if x[0] != 1), key=lambda x: x[0] or 0)
    assert [tuple(r)[2:] for r in found if r["doc_id"] != 1] == [x[2:] for x in _expected(given)]
    assert sorted(tuple(r)[2:] for r in found if r["doc_id"] == 1) == sorted(x[2:] for x in _expected(rows[:3]))
    ends = [r["start"] + r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    assert huffman.stored(docs.limit(0), store.place(spark, "none"), *PATHS).collect() == []


def test_a_damaged_block_raises(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    folder = huffman.save(huffman.tokenized_blocks(docs, *PATHS), store.place(spark, "whole"))
    bad = store.place(spark, "bad")
    spark.read.parquet(f"{folder}/codes").write.parquet(f"{bad}/codes")
    spark.read.parquet(f"{folder}/blocks").withColumn("bits", F.unhex(F.lit("00FF"))).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="damaged"):
        huffman.load(spark, bad).collect()
