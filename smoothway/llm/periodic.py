"""Periodic runs of words, by branching tandem repeats in a suffix tree.

The tree of a text's words is kept as a suffix array with common prefix lengths, whose intervals are
its inner nodes. Of each node only the leaves outside its largest child are looked at (the smaller
halves): leaf i at a node of depth d begins, or ends, a tandem repeat of period d if the leaf d words
after, or before, it hangs on the same node. Repeats are then rotated to the left as far as they go,
which merges all repeats of a run. Nodes too shallow to matter are never made: a run of `least` words
holds a repeat whose period, or a multiple of it, is at least `_shallowest(least)` words long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smoothway.llm.store import fields

#: A run has at least so many words; texts go together into one tree until they have AT_ONCE words.
LEAST, AT_ONCE = 12, 1 << 18
#: Pairs of a node and a leaf that are looked at together.
PAIRS = 1 << 20
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _shallowest(least: int) -> int:
    """Depth from which nodes show all runs of least words: each smaller period has a multiple between it and least / 2."""
    return (max(least, 2) // 2 + 2) // 2


def _repeated(c: np.ndarray, doc: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Those starts whose next depth words have a hash that occurs again in the text."""
    h = doc[: len(c) - depth + 1].astype(np.uint64)
    for j in range(depth):
        h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + c[j : len(c) - depth + 1 + j].astype(np.uint64)
    h = h[starts]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    kept = np.zeros(len(starts), dtype=bool)
    kept[order[1:][same]] = kept[order[:-1][same]] = True
    return starts[kept]


def _suffix_array(c: np.ndarray, doc: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first depth words with another of their text, sorted, and the length
    of the prefix that each shares with the one before it (0 if under depth).

    Prefixes are doubled; the ranks of each round are kept, and common prefixes are read off them.
    """
    after = np.union1d(places, places + depth)
    keys = [c[after + j] for j in range(depth - 1, -1, -1)] + [doc[after]]
    order = np.lexsort(keys)
    sa = after[order]
    new = np.ones(len(sa), dtype=bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    group = np.maximum.accumulate(np.where(new, np.arange(len(sa)), 0))
    alone = lambda: new & np.append(new[1:], True)
    held = ~alone()
    shared = ~new
    rank = np.full(len(c), -1, dtype=np.int32)
    rank[sa] = group
    rounds, k = [rank], depth
    while True:
        open_ = np.flatnonzero(~alone())
        if not len(open_):
            break
        s, g = sa[open_], group[open_]
        ahead = rank[s + k]
        by = np.lexsort((ahead, g))
        sa[open_], ahead = s[by], ahead[by]
        own = np.ones(len(open_), dtype=bool)
        own[1:] = (g[1:] != g[:-1]) | (ahead[1:] != ahead[:-1])
        new[open_] = own
        group[open_] = open_[np.maximum.accumulate(np.where(own, np.arange(len(open_)), 0))]
        rank = rank.copy()
        rank[sa[open_]] = group[open_]
        rounds.append(rank)
        k *= 2
    common = np.zeros(len(sa), dtype=np.int64)
    at = np.flatnonzero(shared)
    a, b = sa[at - 1], sa[at]
    far = np.zeros(len(at), dtype=np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        x = rounds[level][a + far]
        far += (depth << level) * ((x == rounds[level][b + far]) & (x >= 0))
    still = np.ones(len(at), dtype=bool)
    for _ in range(depth - 1):
        x = c[a + far]
        still &= (x == c[b + far]) & (x >= 0)
        far += still
    common[at] = far
    return sa[held], common[held]


def _nodes(common: list[int]) -> np.ndarray:
    """Inner nodes: depth, first and last leaf, first and last leaf of the largest child."""
    found, stack = [], []  # the stack holds the nodes on the way to the current leaf
    for i in range(1, len(common) + 1):
        now = common[i] if i < len(common) else 0
        low = high = i - 1  # the last finished child: at first a leaf
        while stack and stack[-1][0] > now:
            depth, first, big, end = stack.pop()
            if high - low > end - big:
                big, end = low, high
            found.append((depth, first, i - 1, big, end))
            low, high = first, i - 1
        if now:
            if stack and stack[-1][0] == now:
                if high - low > stack[-1][3] - stack[-1][2]:
                    stack[-1] = (now, stack[-1][1], low, high)
            else:
                stack.append((now, low, low, high))
    return np.array(found, dtype=np.int64).reshape(-1, 5)


def _branching(c: np.ndarray, sa: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Branching tandem repeats as rows (end, period), each once, sorted."""
    leaf = np.full(len(c), -1, dtype=np.int32)
    leaf[sa] = np.arange(len(sa))
    depth, first, last, big, end = nodes.T
    node = np.tile(np.arange(len(nodes)), 2)
    begin, many = np.concatenate([first, end + 1]), np.concatenate([big - first, last - end])
    found, upto = [np.zeros((0, 2), dtype=np.int64)], np.cumsum(many)
    done = 0
    while done < len(many):
        to = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + PAIRS, side="right")))
        m = many[done:to]
        i = sa[np.repeat(begin[done:to] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
        v = np.repeat(node[done:to], m)
        d = depth[v]
        for start in (i, i - d):
            other = i + d if start is i else start
            ok = np.flatnonzero((other >= 0) & (other < len(c)))
            at = leaf[other[ok]]
            ok = ok[(at >= first[v[ok]]) & (at <= last[v[ok]])]
            s, p = start[ok], d[ok]
            branches = c[s] != c[s + 2 * p]
            found.append(np.stack([s[branches] + 2 * p[branches], p[branches]], axis=1))
        done = to
    return np.unique(np.concatenate(found), axis=0)


def _leftmost(c: np.ndarray, at: int, period: int) -> int:
    """The least s up to at such that all words from s to at equal those a period after them."""
    many = 32
    while True:
        low = max(0, at - many)
        differs = np.flatnonzero(c[low:at] != c[low + period : at + period])
        if len(differs):
            return low + int(differs[-1]) + 1
        at, many = low, 2 * many


def periodic_runs(texts: list[np.ndarray], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Maximal runs (start, length, period) of each text, given as word numbers; sorted by start, then period.

    A run has at least least words and twice its smallest period, and no word beside it continues it.
    """
    depth = _shallowest(least)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = 1 + np.cumsum(sizes + depth) - (sizes + depth)  # a sign of its own before the first text, depth of them after each
    c = np.full(int(1 + (sizes + depth).sum()), -1, dtype=np.int64)
    starts = []
    for b, t in zip(begins, texts, strict=True):
        c[b : b + len(t)] = t
        starts.append(np.arange(b, b + max(0, len(t) - depth + 1)))
    doc = np.concatenate([np.zeros(1, dtype=np.int64), np.repeat(np.arange(len(texts)), sizes + depth)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    places = _repeated(c, doc, np.concatenate([np.zeros(0, dtype=np.int64), *starts]), depth) if len(c) >= depth else np.zeros(0, dtype=np.int64)
    if not len(places):
        return out
    sa, common = _suffix_array(c, doc, places, depth)
    nodes = _nodes(common.tolist())
    if not len(nodes):
        return out
    ends: dict[int, list[tuple[int, int]]] = {}  # runs that end at a place: start, period
    for end, d in _branching(c, sa, nodes).tolist():
        here = ends.setdefault(end, [])
        if any(d % q == 0 and end - 2 * d >= s for s, q in here):
            continue  # some periods of a run that is known
        s = _leftmost(c, end - 2 * d, d)
        q = next((q for q in range(1, min(depth, d)) if d % q == 0 and (c[s : s + d - q] == c[s + q : s + d]).all()), d)
        here.append((s, q))
        if end - s >= max(least, 2 * q):
            text = int(doc[s])
            out[text].append((s - int(begins[text]), end - s, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that lie in a run after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period in words) and the collapsed text.

    Words are what white space of ASCII leaves. A null or empty text has no words and an empty
    collapsed text. Repeated rows, repeated ids and null ids are documents of their own; an empty table gives no
    rows; other columns are not looked at. A text is looked at whole, in one task.
    """
    schema = fields(f"n_words long, runs {RUNS}, collapsed string", doc_id=docs.schema[doc_id].dataType)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            words = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            done = 0
            while done < len(words):
                numbers, texts, held, to = _Numbers(), [], 0, done
                while to < len(words) and (to == done or held + len(words[to]) <= AT_ONCE):
                    texts.append(np.fromiter(map(numbers.__getitem__, words[to]), np.int64, len(words[to])))
                    held, to = held + len(words[to]), to + 1
                runs = periodic_runs(texts, least)
                part = words[done:to]
                told = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, to - done),
                        pa.array(list(map(len, part)), pa.int64()),
                        pa.array(told, kind),
                        pa.array([_collapsed(w, r) for w, r in zip(part, runs, strict=True)], pa.binary()).cast(pa.string()),
                    ],
                    names=schema.fieldNames(),
                )
                done = to

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(found, schema).withColumnRenamed("doc_id", doc_id)


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text, with a periodic tail in about every tenth text, as the id's checksum decides.

    With h the crc32 of the decimal id and g = h div 10: where h ends in 0, words from a = g % n on repeat
    the p = 1 + (n - a) div (3 + g % 8) words that begin there. Others, null ids and wordless texts stay.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    rows = docs.select(F.col(doc_id), F.col(text).alias("text"), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.expr("IF(n > 0, g % n, NULL)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "concat(slice(words, 1, CAST(a AS INT)), flatten(array_repeat(slice(words, CAST(a + 1 AS INT), CAST(p AS INT)), CAST((n - a + p - 1) div p AS INT))))"
    return rows.select(F.col(doc_id), F.expr(f"IF(p IS NOT NULL, array_join(slice({tail}, 1, n), ' '), text)").alias("text"))
