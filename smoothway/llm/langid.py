"""Language identification by hyperdimensional profiles of letter n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.llm.store import fold

NOT_LETTERS = re.compile(r"[\W\d_]+")
#: N-gram vectors and letter vectors that a task keeps, and n-grams that are summed at a time.
CACHE_GRAMS, CACHE_LETTERS, AT_ONCE = 16_384, 32_768, 2_048


@dataclass(frozen=True)
class Space:
    """dim: length of the vectors; gram: letters bound together; sample: about so many documents of
    each language at most are bundled into its prototype."""

    dim: int = 1024
    gram: int = 3
    sample: int = 1_000


class Vectors:
    """Random letter vectors of +1 and -1, and the n-gram vectors bound from them.

    A letter's vector depends only on its code point, so every task has the same ones. The vector of
    an n-gram is the product of its letters' vectors, each turned by its place.
    """

    def __init__(self, space: Space) -> None:
        self.space = space
        self.letters: dict[int, np.ndarray] = {}
        self.forget()

    def forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.table = np.zeros((AT_ONCE, self.space.dim), dtype=np.float32)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= CACHE_LETTERS:
                self.letters.clear()
            self.letters[point] = np.random.default_rng(7919 * point + 17).integers(0, 2, self.space.dim, dtype=np.int8) * 2 - 1
        return self.letters[point]

    def bound(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams, each given as a number of 21 bits for each letter."""
        out = np.ones((len(grams), self.space.dim), dtype=np.int8)
        for place in range(self.space.gram):
            points, at = np.unique(grams >> 21 * place & 0x1FFFFF, return_inverse=True)
            out *= np.roll(np.stack([self.letter(p) for p in points.tolist()]), place, axis=1)[at]
        return out

    def rows_of(self, grams: np.ndarray) -> np.ndarray:
        """Places in the table of at most AT_ONCE n-grams."""
        if len(self.rows) + len(grams) > CACHE_GRAMS:
            self.forget()
        new = np.array([g for g in grams.tolist() if g not in self.rows], dtype=np.int64)
        if len(new):
            first = len(self.rows)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[first : first + len(new)] = self.bound(new)
            self.rows.update(zip(new.tolist(), range(first, first + len(new)), strict=True))
        return np.fromiter(map(self.rows.__getitem__, grams.tolist()), dtype=np.int64, count=len(grams))

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The sum of a whole text's n-gram vectors, each weighted by the root of its count.

        None if the text has no letter. Runs of all but letters are one blank; so are both ends.
        Distinct n-grams are summed AT_ONCE at a time, so memory doesn't grow with the text's letters.
        """
        plain = NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
        if not plain:
            return None
        pad = " " * max(1, self.space.gram - 1)
        points = np.frombuffer((pad[:1] + plain + pad).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        n = len(points) - self.space.gram + 1
        grams = np.zeros(n, dtype=np.int64)
        for place in range(self.space.gram):
            grams |= points[place : place + n] << 21 * place
        kinds, counts = np.unique(grams, return_counts=True)
        out = np.zeros(self.space.dim, dtype=np.float32)
        for k in range(0, len(kinds), AT_ONCE):
            at = self.rows_of(kinds[k : k + AT_ONCE])  # may replace the table
            out += np.sqrt(counts[k : k + AT_ONCE]).astype(np.float32) @ self.table[at]
        return out


def prototypes(docs: DataFrame, space: Space | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", test_fold: int | None = 2, folds: int = 4) -> dict[str, np.ndarray]:
    """Unit vector of each language: the sum of its documents' unit vectors.

    Learned from rows outside the test fold with a non-null language and a letter, about
    space.sample of each language, chosen by a hash of the id. Partial sums are made in the tasks
    and added up by language and block of rows; what reaches the driver is a vector a language.
    """
    space = space or Space()
    rows = docs.filter(F.col(lang).isNotNull() & F.col(doc_id).isNotNull())
    if test_fold is not None:
        rows = rows.filter(fold(doc_id, folds) != test_fold)
    totals = {r[lang]: r["n"] for r in rows.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not totals:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, space.sample / n) * 1e6)])
    sample = rows.filter(F.pmod(F.xxhash64(doc_id, F.lit(3)), F.lit(1_000_000)) < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums = Vectors(space), {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = vectors.bundle(t)
                if v is not None:
                    sums[name] = sums.get(name, 0) + v / (np.linalg.norm(v) or 1.0)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([s.tolist() for s in sums.values()], type=pa.list_(pa.float64()))], names=["lang", "v"])

    parts = sample.mapInArrow(bundle, "lang string, v array<double>").select("lang", F.posexplode("v").alias("k", "x"))
    summed = parts.groupBy("lang", "k").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v"))
    found = {r["lang"]: np.array([p["x"] for p in r["v"]]) for r in summed.orderBy("lang").collect()}
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in found.items()}


def identify(docs: DataFrame, known: dict[str, np.ndarray], space: Space | None = None, text: str = "text") -> DataFrame:
    """Add lang_pred, the language whose prototype has the greatest cosine, and score, that cosine.

    Only the text is looked at, the whole of it. A null text or one without letters is und with
    score 0, and so is every text if nothing was learned; a negative cosine counts as 0; ties go to
    the first language in order of names. Input columns of these names are replaced, all others stay;
    repeated rows and null ids are rows as any other; an empty table stays empty.
    """
    space = space or Space()
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kept = docs.drop("lang_pred", "score")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, names = Vectors(space), sorted(shared.value)
        matrix = np.stack([shared.value[k] for k in names]).astype(np.float32) if names else None
        for batch in batches:
            langs, scores = [], []
            for t in batch.column(text).to_pylist():
                v = vectors.bundle(t) if names else None
                if v is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cosines = matrix @ v / (np.linalg.norm(v) or 1.0)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, type=pa.string()), pa.array(scores, type=pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(apply, schema)


def languages(docs: DataFrame, space: Space | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, test_fold: int = 2) -> DataFrame:
    """Predictions for all documents by prototypes that never saw the test fold.

    One row per document: doc_id, held_out, lang_pred, score. A null id is in no fold, so it isn't
    held out, but no prototype learns from it; null texts and languages are not learned from either.
    Repeated rows are documents of their own; an empty table gives no rows; other columns are not
    looked at.
    """
    known = prototypes(docs, space, doc_id, text, lang, test_fold, folds)
    found = identify(docs.select(doc_id, text), known, space, text)
    return found.select(doc_id, F.coalesce(fold(doc_id, folds) == test_fold, F.lit(False)).alias("held_out"), "lang_pred", "score")
