"""Token ids in files: canonical length-limited Huffman codes, in blocks that are decoded alone.

A folder holds two Parquet tables. `codes` has the length of each id's code, from which the canonical
codes follow. `blocks` has a row for each block of whole documents, in ascending document order: the
codes of their ids as one bit string (the first bit is the highest of the first byte) and checkpoints,
the bits between each `step` ids and the next. A checkpoint is a place to begin at, so all of a
block's stretches are decoded side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.llm.packing import _Encoded
from smoothway.llm.store import BATCHES, CLEANUP, _settings, discard, fields, written

#: Longest code in bits, ids after which a block ends with its document, ids between two checkpoints.
LIMIT, BLOCK, STEP = 16, 1 << 16, 64
#: Bytes of text in a part. The driver holds one number for each part, 13 MB for 100 TB.
PART_BYTES = 64 << 20
#: Ids whose bits are spread out at a time.
AT_ONCE = 1 << 16
#: Ids are numbers of a vocabulary; the tables of codes are looked up by id.
MOST_ID = 1 << 24


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code none of whose words is longer than limit, by package-merge.

    The limit is raised where so many symbols don't fit. A single symbol takes one bit. Of equal
    counts the earlier symbol counts as the rarer, so equal counts give equal lengths everywhere.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    limit = max(limit, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    coins = np.asarray(counts, dtype=np.int64)[order]
    coin_of = []  # for each level: which of its items are coins, lightest first
    packages = np.zeros(0, dtype=np.int64)
    for _ in range(limit):
        weights = np.concatenate([coins, packages])
        by = np.argsort(weights, kind="stable")
        coin_of.append(by < n)
        level = weights[by]
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_coin in reversed(coin_of):
        used = int(is_coin[:take].sum())
        lengths[:used] += 1
        take = 2 * (take - used)
    found = np.zeros(n, dtype=np.int64)
    found[order] = lengths
    return found


@dataclass
class Codebook:
    """Canonical codes: words of one length follow each other in the order of their ids."""

    ids: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        if len(self.ids) and not 0 <= self.ids.min() <= self.ids.max() < MOST_ID:
            raise ValueError(f"ids must lie between 0 and {MOST_ID}")
        by = np.lexsort((self.ids, self.lengths))
        self.ids, self.lengths = self.ids[by], self.lengths[by].astype(np.int64)
        self.limit = int(self.lengths.max(initial=1))
        # in a table of all words of limit bits each code fills a stretch, and the stretches follow each other
        width = np.int64(1) << (self.limit - self.lengths)
        self.first = np.cumsum(width) - width
        if len(width) and self.first[-1] + width[-1] > 1 << self.limit:
            raise ValueError("these lengths are no prefix code")

    def writer(self) -> tuple[np.ndarray, np.ndarray]:
        """By id: the code, shifted to the highest of limit bits, and its length (0: no code)."""
        code = np.zeros(int(self.ids.max(initial=0)) + 1, dtype=np.uint32)
        length = np.zeros(len(code), dtype=np.uint8)
        code[self.ids], length[self.ids] = self.first, self.lengths
        return code, length

    def reader(self) -> tuple[np.ndarray, np.ndarray]:
        """By the next limit bits: the id whose code they begin with, and its length."""
        ids, length = np.zeros(1 << self.limit, dtype=np.uint32), np.zeros(1 << self.limit, dtype=np.uint8)
        width = np.int64(1) << (self.limit - self.lengths)
        ids[: width.sum()], length[: width.sum()] = np.repeat(self.ids, width), np.repeat(self.lengths, width)
        return ids, length


def encode(ids: np.ndarray, writer: tuple[np.ndarray, np.ndarray], limit: int, step: int = STEP) -> tuple[bytes, np.ndarray]:
    """The bit string of some ids, and the bits from each checkpoint to the next."""
    code, length = writer
    wide = 16 if limit <= 16 else 32
    lifted = (code << np.uint32(wide - limit)).astype(f">u{wide // 8}")
    kept, bits = np.tri(limit + 1, wide, -1, dtype=bool), []  # of a code of k bits, the first k
    for at in range(0, len(ids), AT_ONCE):
        part = ids[at : at + AT_ONCE]
        spread = np.unpackbits(lifted[part].view(np.uint8).reshape(-1, wide // 8), axis=1)
        bits.append(spread[kept[length[part]]])
    gaps = np.add.reduceat(length[ids].astype(np.int64), np.arange(0, len(ids), step)) if len(ids) else np.zeros(0, dtype=np.int64)
    return np.packbits(np.concatenate(bits or [np.zeros(0, dtype=np.uint8)])).tobytes(), gaps


def decode(bits: bytes, gaps: np.ndarray, n: int, reader: tuple[np.ndarray, np.ndarray], limit: int, step: int = STEP) -> np.ndarray:
    """The n ids of a bit string; from all checkpoints at once, an id of each in turn."""
    symbol, length = reader
    raw = np.frombuffer(bits + bytes(step * limit // 8 + 8), dtype=np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = np.cumsum(gaps) - gaps
    out = np.empty((step, len(at)), dtype=np.uint32)
    shift = 32 - limit
    for k in range(step):
        ahead = (window[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(shift)
        out[k] = symbol[ahead]
        at += length[ahead]
    return out.T.reshape(-1)[:n]


def tokenized_blocks(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """A stored table of blocks of plain ids: part, block, first, doc_ids, lengths, n_ids, ids.

    Each text's ids and then id 0; a null text is that id alone. Texts are dealt to parts by ranges of
    the document id, a null id first; rows that share an id are told apart by their text's hash, equal
    rows by where they are read, so no id fills a part. first counts the ids before the block in its part.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = rows.repartitionByRange(max(1, -(-total // PART_BYTES)), "id", "hash", "row").sortWithinPartitions("id", "hash", "row").select("id", "text")
    kind = docs.schema[doc_id].dataType
    schema = fields("part int, block int, first long, lengths array<int>, n_ids long, ids binary", doc_ids=T.ArrayType(kind))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, part = _Encoded(tokenizer_path, ranks_path), TaskContext.get().partitionId()
        number = first = held = 0
        names: list[pa.Array] = []
        ids: list[bytes] = []

        def made() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            if flat.max(initial=0) < 1 << 16:
                flat = flat.astype("<u2")
            keys = pa.concat_arrays(names)
            values = [pa.ListArray.from_arrays([0, len(keys)], keys), [part], [number], [first], [[len(x) // 4 for x in ids]], [held], [flat.tobytes()]]
            kinds = [None, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([v if k is None else pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=schema.fieldNames())

        for batch in batches:
            begun = 0
            for k, t in enumerate(batch.column(1).to_pylist()):
                ids.append(encoded.ids(t or ""))
                held += len(ids[-1]) // 4
                if held >= block:
                    names.append(batch.column(0).slice(begun, k + 1 - begun))
                    yield made()
                    number, first, held, begun = number + 1, first + held, 0, k + 1
                    names, ids = [], []
            if begun < batch.num_rows:
                names.append(batch.column(0).slice(begun))
        if ids:
            yield made()

    return written(dealt.mapInArrow(cut, schema), "ids", "zstd")


def _plain(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4")


def _counts(raw: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All ids, ascending, and how often each occurs; as many rows as the vocabulary at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.bincount(_plain(ids, n), minlength=len(total))
                own[: len(total)] += total
                total = own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["id", "n"])

    told = raw.select("ids", "n_ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id")
    return told["id"].to_numpy(dtype=np.int64), told["n"].to_numpy(dtype=np.int64)


def save(raw: DataFrame, folder: str, limit: int = LIMIT, step: int = STEP) -> str:
    """Write blocks of ids (from tokenized_blocks) as a folder of codes and coded blocks."""
    spark = raw.sparkSession
    ids, counts = _counts(raw)
    lengths = code_lengths(counts, limit)
    spark.createDataFrame(pd.DataFrame({"id": ids, "length": lengths}), "id long, length long").coalesce(1).write.parquet(f"{folder}/codes")
    book = Codebook(ids, lengths)
    writer, widest = book.writer(), book.limit
    parts = raw.groupBy("part").agg(F.sum("n_ids").alias("n")).toPandas().sort_values("part")
    base = np.zeros(int(parts["part"].max()) + 2 if len(parts) else 1, dtype=np.int64)
    base[parts["part"].to_numpy(dtype=np.int64) + 1] = parts["n"]
    base = np.cumsum(base)
    schema = fields("part int, block int, start long, lengths array<int>, n_ids long, step int, gaps array<int>, bits binary, bits_crc32 long", doc_ids=raw.schema["doc_ids"].dataType)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, gaps, bits = [], [], []
            for part, first, n, plain in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "n_ids", "ids")), strict=True):
                told = encode(_plain(plain, n), writer, widest, step)
                start.append(int(base[part]) + first)
                bits.append(told[0])
                gaps.append(told[1])
            columns = [batch.column("doc_ids"), batch.column("part"), batch.column("block"), pa.array(start, pa.int64()), batch.column("lengths"), batch.column("n_ids"), pa.array([step] * len(start), pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gaps, pa.list_(pa.int32())), pa.array(bits, pa.binary()), pa.array(map(zlib.crc32, bits), pa.int64())], names=schema.fieldNames())

    with _settings(spark, {CLEANUP: "true", **BATCHES, "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}):
        raw.mapInArrow(coded, schema).write.option("compression", "none").parquet(f"{folder}/blocks")
    return folder


def load(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """The documents of a folder: doc_id, start (ids before it), n_tokens, ids_crc32, and ids if asked for.

    A block is read without any other; one whose bits don't have their checksum raises.
    """
    told = spark.read.parquet(f"{folder}/codes").toPandas()
    book = Codebook(told["id"].to_numpy(dtype=np.int64), told["length"].to_numpy(dtype=np.int64))
    reader, widest = book.reader(), book.limit
    blocks = spark.read.parquet(f"{folder}/blocks").select("start", "doc_ids", "lengths", "n_ids", "step", "gaps", "bits", "bits_crc32")
    schema = fields("start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids, doc_id=blocks.schema["doc_ids"].dataType.elementType)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rest = batch.column("doc_ids"), [batch.column(c) for c in ("start", "n_ids", "step", "bits", "bits_crc32", "lengths", "gaps")]
            for k in range(batch.num_rows):
                start, n, step, bits, crc = (c[k].as_py() for c in rest[:5])
                if zlib.crc32(bits) != crc:
                    raise ValueError(f"the block at id {start} of {folder} is damaged")
                lengths = rest[5][k].values.to_numpy().astype(np.int64)
                ids = decode(bits, rest[6][k].values.to_numpy().astype(np.int64), n, reader, widest, step).astype("<u4")
                ends = np.cumsum(lengths)
                each = [ids[b - m : b] for b, m in zip(ends, lengths, strict=True)]
                columns = [keys[k].values, pa.array(start + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                if keep_ids:
                    columns.append(pa.array([x.view("<i4") for x in each], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return blocks.mapInArrow(decoded, schema)


def stored(docs: DataFrame, folder: str, tokenizer_path: str, ranks_path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize all documents, write them as a folder of coded blocks, and read that folder.

    Null and empty texts are the end sign alone; repeated ids, repeated rows and null ids (which come
    first) are documents of their own; an empty table gives a folder without blocks and no rows; other
    columns are not looked at.
    """
    raw = tokenized_blocks(docs, tokenizer_path, ranks_path, doc_id, text)
    save(raw, folder)
    discard(raw)
    return load(docs.sparkSession, folder).withColumnRenamed("doc_id", doc_id)
