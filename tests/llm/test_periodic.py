"""Periodic runs against every period tried in turn."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from smoothway.llm import periodic, queries


def plain_runs(c, least):
    """All periods from 1 on; a stretch that a smaller period also has is that period's."""
    found, c = {}, np.asarray(c)
    for q in range(1, len(c) // 2 + 1):
        same = np.concatenate([[False], c[:-q] == c[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b - a + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def _texts(seed):
    rng = random.Random(seed)
    for _ in range(60):
        letters, text = rng.choice([1, 2, 3, 30]), []
        while len(text) < rng.choice([0, 5, 40, 150]):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 9))]
            text += (unit * 12)[: rng.randint(1, 60)]
        yield text
    for unit in range(1, 9):  # least lengths of each period, one more and one less
        for more in (-1, 0, 1):
            yield [100, *(list(range(unit)) * 20)[: max(12, 2 * unit) + more], 101]
    yield [0, 1] * 300 + [0] * 300 + [1, 0, 0] * 100
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    yield b


@pytest.mark.parametrize("least", [2, 5, 12, 13, 30])
def test_runs_are_those_of_all_periods(least):
    texts = list(_texts(least))
    found = periodic.periodic_runs([np.array(t, dtype=np.int64) for t in texts], least)
    assert found == [plain_runs(t, least) for t in texts]
    assert sum(map(len, found)) > 50


def test_small_chunks_of_pairs_change_nothing(monkeypatch):
    texts = [np.array(t, dtype=np.int64) for t in _texts(1)]
    whole = periodic.periodic_runs(texts)
    monkeypatch.setattr(periodic, "PAIRS", 3)
    assert periodic.periodic_runs(texts) == whole


def test_long_texts_take_nearly_linear_time():
    import time

    took = []
    for n in (100_000, 400_000):
        text, began = np.arange(n) % 7 + (np.arange(n) > n // 2) * 3, time.process_time()
        assert len(periodic.periodic_runs([text])[0]) == 2
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0]


def test_only_leaves_outside_the_largest_child_are_met(monkeypatch):
    met = []
    monkeypatch.setattr(periodic.np, "repeat", lambda a, m, f=np.repeat: met.append(int(np.sum(m))) or f(a, m))
    periodic.periodic_runs([np.zeros(4096, dtype=np.int64)])
    assert max(met) < 2 * 4096  # a leaf or two at each of 4,000 nodes, not 4,096 * 4,096 / 2


ODD = [(1, "a b " * 10), (1, "a b " * 10), (2, None), (3, ""), (4, " \t\n"), (None, "x " * 12 + "y"), (5, "é ü " * 12), (6, "a b c " * 3 + "a b d")]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(k, t, 9) for k, t in ODD], "doc_id long, text string, runs int")
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.collapse(docs.coalesce(1)).collect()]
    assert found == [
        (1, 20, [(0, 20, 2)], "a b"),
        (1, 20, [(0, 20, 2)], "a b"),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (4, 0, [], ""),
        (None, 13, [(0, 12, 1)], "x y"),
        (5, 12, [(0, 12, 1)], "é ü"),
        (6, 12, [], "a b c a b c a b c a b d"),
    ]
    assert periodic.collapse(docs.limit(0)).collect() == []
    assert periodic.planted(docs).count() == len(ODD)


def test_query_against_a_plain_version(spark, sf_dir):
    told = {r["doc_id"]: r for r in queries.op12_runs(spark, sf_dir).collect()}
    n_planted = 0
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = (row["text"] or "").encode().split()
        words, h = [w.decode() for w in words], zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            n_planted += 1
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        runs = plain_runs([number[w] for w in words], 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)), len(words))
        assert tuple(told.pop(row["doc_id"]))[1:] == expected
    assert not told
    assert n_planted > 10
