"""Benchmark decontamination: a broadcast set of test n-grams, verified hits, marked word spans."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.llm.store import spare, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
#: Bytes of test text in one broadcast block; a larger test set is scanned in several blocks.
BLOCK_BYTES = 8 << 20
LEAK = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])

#: The same in Arrow.
KIND = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, runs of digits, letters and all beyond ASCII."""
    return WORD.findall(text.lower()) if text else []


def _rolled(codes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit code of each run of length words."""
    out = np.zeros(max(0, len(codes) - length + 1), dtype=np.uint64)
    for j in range(length):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[j : j + len(out)]
    return out ^ (out >> np.uint64(29))


def _codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


@dataclass
class Windows:
    """Windows of one length in a block: sorted codes, the item of each, and its place in the words."""

    codes: np.ndarray
    items: np.ndarray
    places: np.ndarray


@dataclass
class Index:
    """A block of test items: their ids, their words in one text (a space after each), where each word
    begins, and the windows by length. Some 25 bytes for a word, none of them Python objects."""

    ids: list[str]
    text: bytes
    begins: np.ndarray
    windows: dict[int, Windows]


def index(items: list[tuple[str, bytes]], size: int = WINDOW) -> Index:
    """Items of fewer words than size, but not none, are one window."""
    each = [words_of(text) for _, text in items]
    text = b"".join(w + b" " for words in each for w in words)
    begins = np.concatenate([[0], np.cumsum([len(w) + 1 for words in each for w in words], dtype=np.int64)]).astype(np.int64)
    found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
    first = 0
    for k, words in enumerate(each):
        if words:
            length = min(size, len(words))
            codes = _rolled(_codes(words), length)
            found[length].append((codes, np.full(len(codes), k, dtype=np.int32), np.arange(first, first + len(codes), dtype=np.int64)))
        first += len(words)
    windows = {}
    for length, parts in found.items():
        codes, of, places = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(codes, kind="stable")
        windows[length] = Windows(codes[order], of[order], places[order])
    return Index([i for i, _ in items], text, begins, windows)


class _Scan:
    """Finds every occurrence of a block's windows in texts; used inside tasks."""

    def __init__(self, block: Index) -> None:
        self.block, self.maybe = block, {}
        for length, known in block.windows.items():
            slots = 1 << max(16, (8 * len(known.codes) - 1).bit_length())  # at most an eighth of them is taken
            table = np.zeros(slots, dtype=bool)
            table[(known.codes % np.uint64(slots)).astype(np.int64)] = True
            self.maybe[length] = table

    def items_at(self, code: np.uint64, words: list[bytes], length: int) -> set[str]:
        """Ids of the items that have these very words as a window."""
        block, known = self.block, self.block.windows[length]
        low, high = np.searchsorted(known.codes, code, "left"), np.searchsorted(known.codes, code, "right")
        if low == high:
            return set()
        said = b" ".join(words) + b" "
        return {block.ids[known.items[k]] for k in range(low, high) if block.text[block.begins[known.places[k]] : block.begins[known.places[k] + length]] == said}

    def __call__(self, texts: list[bytes | None]) -> Iterator[dict]:
        each = [words_of(t) for t in texts]
        ends = np.cumsum([len(w) for w in each], dtype=np.int64)
        flat = [w for words in each for w in words]
        codes, hit = _codes(flat), np.zeros(len(flat), dtype=bool)
        items: dict[int, set[str]] = defaultdict(set)
        for length, maybe in self.maybe.items():
            rolled = _rolled(codes, length)
            for i in np.nonzero(maybe[(rolled % np.uint64(len(maybe))).astype(np.int64)])[0]:
                doc = int(np.searchsorted(ends, i, side="right"))
                if i + length <= ends[doc] and (of := self.items_at(rolled[i], flat[i : i + length], length)):
                    hit[i : i + length] = True
                    items[doc] |= of
        for doc, (text, words) in enumerate(zip(texts, each, strict=True)):
            runs, spans = [], []
            if doc in items:
                begin = int(ends[doc]) - len(words)
                edge = np.diff(np.concatenate([[0], hit[begin : begin + len(words)].astype(np.int8), [0]]))
                runs = list(zip(np.nonzero(edge == 1)[0].tolist(), (np.nonzero(edge == -1)[0] - 1).tolist(), strict=True))
                at = [m.span() for m in WORD.finditer(text.lower())]
                points, upto = 0, 0
                for a, b in runs:  # spans in code points, each text counted through once
                    points, upto = points + len(text[upto : at[a][0]].decode("utf-8", "replace")), at[a][0]
                    start = points
                    points, upto = points + len(text[upto : at[b][1]].decode("utf-8", "replace")), at[b][1]
                    spans.append((start, points))
            yield {"n_words": len(words), "hits": [{"first": a, "last": b} for a, b in runs], "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items.get(doc, ()))}


def _joined(one: dict, two: dict) -> dict:
    """Hits of two blocks of test items in the same text."""
    def merged(runs: list[tuple[int, int]], gap: int) -> list[list[int]]:
        out: list[list[int]] = []
        for a, b in sorted(runs):
            if out and a <= out[-1][1] + gap:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    hits = merged([(h["first"], h["last"]) for h in one["hits"] + two["hits"]], 1)
    spans = merged([(s["start"], s["end"]) for s in one["spans"] + two["spans"]], 0)
    return {"n_words": one["n_words"], "hits": [{"first": a, "last": b} for a, b in hits], "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted({*one["items"], *two["items"]})}


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES, into: str = "leak") -> DataFrame:
    """Add a struct column of each document's verified matches with test items.

    leak.n_words: words of the text; leak.hits: word runs covered by matching windows;
    leak.spans: the same as code points, end exclusive; leak.items: ids (as strings) of the items.
    A null or empty text has no words and no hits; items with a null id or text have no windows;
    repeated items count once; repeated rows and null ids of docs are documents of their own; an
    empty table stays empty; an input column of the same name as the result is replaced, all others
    stay, whatever their names. Test items of more than block_bytes are scanned in blocks, one after
    another: the hits of a block are written before the next is broadcast, so a task holds one block
    and one Python process however many there are, and the driver as much.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t")).dropna().distinct()

    def blocks() -> Iterator[list[tuple[str, bytes]]]:
        """The items in order, so many at a time; no more than one block is held here."""
        block, held = [], 0
        for row in rows.orderBy("i", "t").toLocalIterator():
            if held and held + len(row["t"]) > block_bytes:
                yield block
                block, held = [], 0
            block.append((row["i"], bytes(row["t"])))
            held += len(row["t"])
        yield block

    found, each = docs.drop(into), blocks()
    first, second = next(each), next(each, None)
    if second is None:
        return _scanned(found, first, size, text, into)
    (row,) = spare(found, "row")
    keyed = written(found.withColumn(row, F.monotonically_increasing_id()), "leak-docs", "zstd")
    parts = []
    for block in chain([first, second], each):
        hits = _scanned(keyed.select(row, text), block, size, text, into).select(row, into)
        parts.append(written(hits if not parts else hits.filter(F.size(f"{into}.items") > 0), "leak-hits", "zstd"))  # the first has a row for each document
    met = reduce(DataFrame.unionByName, parts).groupBy(row).agg(F.collect_list(into).alias(into))
    kinds = T.StructType([T.StructField(row, T.LongType()), T.StructField(into, LEAK)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([reduce(_joined, marks) for marks in batch.column(1).to_pylist()], type=KIND)], names=kinds.fieldNames())

    return keyed.join(met.mapInArrow(join, kinds), row).drop(row)


def _scanned(docs: DataFrame, block: list[tuple[str, bytes]], size: int, text: str, into: str) -> DataFrame:
    """docs with the hits of one block of test items."""
    shared = docs.sparkSession.sparkContext.broadcast(index(block, size))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scan(shared.value)
        for batch in batches:
            marks = pa.array(list(scanner(batch.column(text).cast(pa.binary()).to_pylist())), type=KIND)
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], names=[*batch.schema.names, into])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(into, LEAK)]))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words; repeated rows and null ids are documents of their own; an
    empty table gives no rows, and without items nothing is hit; other columns are not looked at.
    """
    marked = find_leaks(docs.select(doc_id, text), items, text=text, **options)
    n_hit = F.aggregate("leak.hits", F.lit(0).cast("long"), lambda n, h: n + (h["last"] - h["first"] + 1).cast("long"))
    return marked.select(
        doc_id,
        F.col("leak.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "leak.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.col("leak.spans").alias("spans"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", remove: str = "documents", **options) -> DataFrame:
    """Remove contaminated documents, or (remove="spans") only the matching spans of their texts.

    Null and empty texts stay, repeated rows and null ids too; an empty table stays empty. Columns
    stay as they are, whatever their names; with spans, n_chars (if there) is counted anew.
    """
    leak, cut = spare(docs, "leak", "cut")
    marked = find_leaks(docs, items, text=text, into=leak, **options)
    if remove == "documents":
        return marked.filter(F.size(f"{leak}.hits") == 0).drop(leak)
    if remove != "spans":
        raise ValueError(f"remove: documents or spans, not {remove}")
    whole = F.col(text)
    state = F.aggregate(
        f"{leak}.spans",
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["kept"], whole.substr(acc["at"] + 1, s["start"] - acc["at"])).alias("kept"), s["end"].alias("at")),
    )
    without = marked.withColumn(cut, state).withColumn(text, F.when(F.size(f"{leak}.spans") == 0, whole).otherwise(F.concat(f"{cut}.kept", whole.substr(F.col(f"{cut}.at") + 1, F.char_length(whole)))))
    if "n_chars" in docs.columns:
        without = without.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return without.select(*docs.columns)


def digest(items: list[str]) -> str:
    """items_sha256 of the given item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
