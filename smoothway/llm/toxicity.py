"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.llm.store import fold, spare

WORD = re.compile(r"\w+")
THRESHOLD = 0.7
CACHE_WORDS = 200_000


@dataclass(frozen=True)
class Model:
    """Settings of training. sample: at most about so many labelled rows of each class are fitted."""

    bits: int = 20
    stem: int = 4
    sample: int = 4_000
    shard_rows: int = 4_000
    epochs: int = 6
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 16.0
    l2: float = 0.1


class _Hashes(dict):
    """Word -> crc32 of the word and of its first letters, as one number; bounded in size."""

    def __init__(self, stem: int) -> None:
        super().__init__()
        self.stem = stem

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = code = zlib.crc32(word.encode("utf-8", "replace")) << 32 | zlib.crc32(word[: self.stem].encode("utf-8", "replace"))
        return code


def _features(codes: np.ndarray, bits: int) -> np.ndarray:
    """Hashed features of a run of words, four for each: word, stem, pair, pair around one word.

    Row k belongs to word k; pairs that would leave the run fall on an unused slot 0.
    """
    mask, n = np.uint64((1 << bits) - 1), len(codes)
    word, stem = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)
    out = np.zeros((n, 4), dtype=np.int64)
    spread = lambda x: (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)
    out[:, 0] = spread(word * np.uint64(3) + np.uint64(1)) & mask
    out[:, 1] = spread(stem * np.uint64(5) + np.uint64(2)) & mask
    out[: max(n - 1, 0), 2] = spread(word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:]) & mask
    out[: max(n - 2, 0), 3] = spread(word[:-2] * np.uint64(0x165667B19E3779F9) + word[2:] + np.uint64(7)) & mask
    return out


def _train(texts: list[str], labels: list[int], how: Model) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over the rows in a fixed shuffled order; the non-zero weights and their slots.

    Slot 0 is the bias. Every feature counts once in a text; the rarer class weighs as much in all
    as the other.
    """
    share = sum(labels) / max(1, len(labels))
    weight = {1: max(1.0, (1 - share) / max(share, 1e-9)), 0: max(1.0, share / max(1 - share, 1e-9))}
    size, hashes = 1 << how.bits, _Hashes(how.stem)
    z, n = np.zeros(size), np.zeros(size)
    rows = []
    for text in texts:
        words = WORD.findall(text.lower())
        codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        rows.append(np.unique(np.append(_features(codes, how.bits), 0)).astype(np.int32))
    for epoch in range(how.epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            i = rows[k]
            zi, ni = z[i], n[i]
            l1 = np.where(i == 0, 0.0, how.l1)
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((how.beta + np.sqrt(ni)) / how.alpha + how.l2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            g *= weight[labels[k]]
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha * w
            n[i] = ni + g * g
    l1 = np.full(size, how.l1)
    l1[0] = 0
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))
    at = np.nonzero(w)[0]
    return at, w[at]


def fit(docs: DataFrame, labels: DataFrame, how: Model | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", test_fold: int | None = 1, folds: int = 3) -> dict[str, np.ndarray]:
    """Learn weights from labelled rows outside the test fold.

    A document is toxic if any of its label rows says so; null labels and labels of unknown
    documents don't count. At most about how.sample rows of each class are fitted, chosen by a hash
    of the id, on tasks of about how.shard_rows rows whose weights are averaged; what reaches the
    driver is at most 2**how.bits numbers. Without rows of both classes every score is near the only
    label there is (0 if there is none).
    """
    how = how or Model()
    marked = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(F.col(label).cast("int")).alias("_y"))
    if test_fold is not None:
        marked = marked.filter(fold(doc_id, folds) != test_fold)
    totals = {int(r["_y"]): r["n"] for r in marked.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return {"at": np.array([0]), "w": np.array([30.0 if totals.get(1) else -30.0])}
    part = F.when(F.col("_y") == 1, min(1.0, how.sample / totals[1])).otherwise(min(1.0, how.sample / totals[0]))
    sample = marked.filter(F.pmod(F.xxhash64(doc_id), F.lit(1_000_000)) < part * 1_000_000)
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("_t")).join(F.broadcast(sample), doc_id)
    shards = max(1, -(-(min(totals[0], how.sample) + min(totals[1], how.sample)) // how.shard_rows))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_h", "_t"])
        at, w = _train(group["_t"].tolist(), group["_y"].tolist(), how)
        return pd.DataFrame({"at": at, "w": w})

    each = rows.select("_t", "_y", F.xxhash64(doc_id).alias("_h"), F.pmod(F.xxhash64(doc_id, F.lit(7)), F.lit(shards)).alias("_shard")).groupBy("_shard").applyInPandas(train, "at long, w double")
    found = each.groupBy("at").agg(F.sum("w").alias("w")).orderBy("at").toPandas()
    at, w = found["at"].to_numpy(), found["w"].to_numpy() / shards
    return {"at": at, "w": w}


def score(docs: DataFrame, weights: dict[str, np.ndarray], how: Model | None = None, text: str = "text", into: str = "score") -> DataFrame:
    """Add the probability of label 1 of each whole text; null and empty texts have the bias's.

    An input column of the result's name is replaced, all others stay; repeated rows and null ids are
    rows as any other; an empty table stays empty.
    """
    how = how or Model()
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.drop(into)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << how.bits, dtype=np.float64)
        table[shared.value["at"]] = shared.value["w"]
        bias, table[0] = table[0], 0.0
        hashes = _Hashes(how.stem)
        for batch in batches:
            each = [WORD.findall(t.lower()) if t else [] for t in batch.column(text).to_pylist()]
            ends = np.cumsum([len(w) for w in each], dtype=np.int64)
            codes = np.fromiter((c for words in each for c in map(hashes.__getitem__, words)), dtype=np.uint64, count=int(ends[-1]) if len(ends) else 0)
            at = _features(codes, how.bits)
            if len(ends):
                starts = np.concatenate([[0], ends[:-1]])
                last, first = ends[ends > starts] - 1, starts[ends > starts]
                at[last, 2:] = 0  # pairs don't cross from one text into the next
                at[(last - 1)[last > first], 3] = 0
            row, col = np.nonzero(table[at])
            pairs = np.unique(np.stack([np.searchsorted(ends, row, side="right"), at[row, col]], axis=1), axis=0) if len(row) else np.zeros((0, 2), dtype=np.int64)
            margin = bias + np.bincount(pairs[:, 0], weights=table[pairs[:, 1]], minlength=len(each))
            out = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, into])

    return kept.mapInArrow(apply, T.StructType([*kept.schema.fields, T.StructField(into, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, how: Model | None = None, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, folds: int = 3, test_fold: int = 1) -> DataFrame:
    """Scores and predictions of all documents by a model that never saw the test fold's labels.

    One row per document: doc_id, held_out, score, predicted. A null id is in no fold and has no
    label; repeated rows are documents of their own, and one with repeated labels is toxic if any
    says so; an empty table gives no rows; other columns are not looked at.
    """
    weights = fit(docs, labels, how, doc_id, text, test_fold=test_fold, folds=folds)
    scored = score(docs.select(doc_id, text), weights, how, text)
    return scored.select(doc_id, F.coalesce(fold(doc_id, folds) == test_fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, how: Model | None = None, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with their own columns, whatever their names.

    Null and empty texts have the bias's score; repeated rows and null ids are rows as any other; an
    empty table stays empty.
    """
    (mark,) = spare(docs, "score")
    return score(docs, fit(docs, labels, how, doc_id, text), how, text, mark).filter(F.col(mark) < threshold).drop(mark)
