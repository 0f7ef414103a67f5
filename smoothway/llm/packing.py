"""Best-fit packing by minimum bin slack over token counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.llm.store import numbered, written

CAPACITY = 2048
#: Bytes of distinct word encodings that a task keeps.
CACHE_WORDS = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Encoded(dict):
    """Space-led word -> its ids as little-endian bytes; bounded in size.

    Texts of plain Latin letters go whole through the same vocabulary as ranks, which is faster. Of
    others the words are encoded apart, as this tokenizer's pre-tokens never cross a single space
    between two other characters: Latin words through the ranks, the rest through the tokenizer itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.quick = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        quick = self.quick is not None and (word.isascii() or max(word) < "ɐ")
        ids = np.array(self.quick.encode_ordinary(word), dtype="<u4").tobytes() if quick else self.slow(word)
        if len(word) < 64:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, then id 0."""
        if not text:
            return b"\0\0\0\0"
        if any(s in text for s in self.special):
            return self.slow(text) + b"\0\0\0\0"
        if self.quick is not None and (text.isascii() or max(text) < "ɐ"):
            return np.array(self.quick.encode_ordinary(text), dtype="<u4").tobytes() + b"\0\0\0\0"
        parts = text.split(" ")
        words, held = [], parts[0]
        for part in parts[1:]:  # only a space between two characters that aren't white space ends a word
            if part and held and not part[0].isspace() and not held[-1].isspace():
                words.append(held)
                held = " " + part
            else:
                held += " " + part
        words.append(held)
        return b"".join(map(self.__getitem__, words)) + b"\0\0\0\0"


def tokenized(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of documents: doc_id, piece, start, length, ids_crc32 (and ids, if asked for).

    A text's ids end with id 0; a null text is that id alone. Texts of more than capacity ids are
    cut into pieces of capacity, of which the first takes what is left over.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    if keep_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _Encoded(tokenizer_path, ranks_path)
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                ids = encoded.ids(t or "")
                n, at, p = len(ids) // 4, 0, 0
                take = n % capacity or min(n, capacity)
                while at < n:
                    part = ids[4 * at : 4 * (at + take)]
                    row.append(k)
                    piece.append(p)
                    start.append(at)
                    length.append(take)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        kept.append(np.frombuffer(part, dtype="<i4"))
                    at, p, take = at + take, p + 1, capacity
            columns = [batch.column(0).take(pa.array(row, type=pa.int64())), pa.array(piece, type=pa.int32()), pa.array(start, type=pa.int64()), pa.array(length, type=pa.int64()), pa.array(crc, type=pa.int64())]
            if keep_ids:
                columns.append(pa.array(kept, type=pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema)


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins for the given number of pieces of each length: (length -> pieces in one bin, bins).

    Each bin takes the longest piece left and the subset of all others that fills the rest best,
    found by subset sums in a bitset; the same combination is taken as often as the counts allow.
    Input and output are bounded by the capacity, not by the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a length is beyond the capacity")
    out: list[tuple[dict[int, int], int]] = []
    while left:
        longest = max(left)
        rest = capacity - longest
        steps: list[tuple[int, int]] = []  # length (times a power of two), its copies in one step
        reach, seen, target = 1, [], 1 << rest
        for n in sorted((n for n in left if n <= rest), reverse=True):
            most, k = min(left[n] - (n == longest), rest // n), 1
            while most > 0:
                k = min(k, most)
                seen.append(reach)
                steps.append((n, k))
                reach |= (reach << (n * k)) & ((target << 1) - 1)
                most, k = most - k, 2 * k
            if reach & target:
                break
        at = reach.bit_length() - 1
        take = {longest: 1}
        for (n, k), before in zip(reversed(steps), reversed(seen), strict=True):
            if not before >> at & 1:
                take[n] = take.get(n, 0) + k
                at -= n * k
        times = min(left[n] // k for n, k in take.items())
        out.append((take, times))
        for n, k in take.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (a stored table with doc_id, piece, length).

    The decision needs only how many pieces there are of each length, at most capacity numbers;
    the pieces of a length are then numbered without a shared task and looked up in the bins.
    """
    spark = pieces.sparkSession
    counts = {int(r["length"]): r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, base, used = [], 0, dict.fromkeys(counts, 0)
    for take, times in minimum_bin_slack(counts, capacity):
        offset = 0
        for n in sorted(take, reverse=True):
            rows.append((n, used[n], used[n] + take[n] * times, take[n], base, offset))
            used[n] += take[n] * times
            offset += n * take[n]
        base += times
    bins = spark.createDataFrame(pd.DataFrame(rows, columns=["_n", "_from", "_to", "_k", "_base", "_offset"], dtype="int64"), "_n long, _from long, _to long, _k long, _base long, _offset long")
    ranked = numbered(pieces, ["length"], [c for c in ("doc_id", "piece", "ids_crc32", "_piece") if c in pieces.columns], "_rank")
    found = ranked.join(F.broadcast(bins), (F.col("length") == F.col("_n")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    found = found.withColumn("sequence_id", F.col("_base") + F.floor(nth / F.col("_k")).cast("long")).withColumn("offset", F.col("_offset") + nth % F.col("_k") * F.col("length"))
    return found.select(*pieces.columns, "sequence_id", "offset")


def packed(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """All documents as pieces placed in sequences of at most capacity ids; with keep_ids, their ids too.

    Null and empty texts are the end sign alone; repeated ids and texts and null ids are documents of
    their own; an empty table gives no rows; other columns are not looked at.
    """
    whole = written(tokenized(docs, tokenizer_path, ranks_path, capacity, doc_id, text, keep_ids).withColumn("_piece", F.monotonically_increasing_id()), "pieces", "zstd" if keep_ids else None)
    placed = pack(whole.drop("ids"), capacity)
    if keep_ids:  # the ids move once, when all is decided
        placed = written(placed, "placed").join(whole.select("_piece", "ids"), "_piece")
    return placed.drop("_piece")
