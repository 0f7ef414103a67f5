"""Operators that learn or divide, against plain versions on small tables."""

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from smoothway.llm import langid, sharding, simhash, toxicity

# --- language ----------------------------------------------------------------------------------------

TEXTS = {
    "en": ["the cat sat on the mat with the other cats", "when the rain is over we go out to the sea", "they thought that this was the end of the way"],
    "de": ["der hund und die katze sind nicht im haus", "wenn der regen vorbei ist gehen wir hinaus", "sie dachten dass dies das ende des weges ist"],
    "fr": ["le chat et le chien ne sont pas dans la maison", "quand la pluie est finie nous sortons vers la mer", "ils pensaient que ceci était la fin du chemin"],
}


def plain_vector(text, dim):
    """Product of turned letter vectors for each run of three letters, letter by letter."""
    letters = langid.NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return None
    letters, counts = f" {letters}  ", defaultdict(int)
    letter = lambda c: np.random.default_rng(7919 * ord(c) + 17).integers(0, 2, dim, dtype=np.int8) * 2 - 1
    for i in range(len(letters) - 2):
        counts[letters[i : i + 3]] += 1
    out = np.zeros(dim)
    for gram, n in counts.items():
        v = np.ones(dim)
        for place, c in enumerate(gram):
            v = v * np.roll(letter(c), place)
        out += math.sqrt(n) * v
    return out


def test_op2_against_plain_vectors(spark):
    dim = 256
    rows = [(10 * k + j, t, lang) for k, (lang, own) in enumerate(TEXTS.items()) for j, t in enumerate(own)]
    rows += [(900, None, "en"), (901, "12 ?!", "de"), (None, "the cat and the dog", "en"), (902, "la mer et le chat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    known = {}
    for i, t, lang in rows:
        v = plain_vector(t or "", dim)
        if i is not None and lang and not held(i) and v is not None:
            known[lang] = known.get(lang, 0) + v / np.linalg.norm(v)
    known = {k: v / np.linalg.norm(v) for k, v in known.items()}
    found = {r["doc_id"]: r for r in langid.languages(docs, langid.Space(dim=dim)).collect()}
    for i, t, _ in rows:
        v = plain_vector(t or "", dim)
        cosines = {k: float(p @ v / np.linalg.norm(v)) for k, p in known.items()} if v is not None else {}
        best = max(cosines, key=cosines.get) if cosines else "und"
        assert (found[i]["lang_pred"], found[i]["held_out"]) == (best, held(i))
        assert abs(found[i]["score"] - max(0.0, cosines.get(best, 0.0))) < 1e-4


def test_op2_memory_of_many_letters_is_bounded():
    vectors = langid.Vectors(langid.Space(dim=64))
    text = "".join(chr(0x4E00 + k * 7 % 20_000) for k in range(30_000))
    assert np.allclose(vectors.bundle(text), plain_vector(text, 64), atol=1e-2)
    assert len(vectors.table) <= langid.CACHE_GRAMS


# --- toxicity ----------------------------------------------------------------------------------------

def plain_features(text, how):
    """Slots of a text: words, stems, pairs and pairs around one word, one at a time."""
    words = [w.lower() for w in re.findall(r"\w+", text)]
    mask, big = (1 << how.bits) - 1, 1 << 64
    spread = lambda x: ((x ^ x >> 31) * 0x9E3779B97F4A7C15 % big >> 17) & mask
    code, out = [zlib.crc32(w.encode()) for w in words], set()
    for k, w in enumerate(words):
        out |= {spread(code[k] * 3 + 1), spread(zlib.crc32(w[: how.stem].encode()) * 5 + 2)}
        if k + 1 < len(words):
            out.add(spread((code[k] * 0xC2B2AE3D27D4EB4F + code[k + 1]) % big))
        if k + 2 < len(words):
            out.add(spread((code[k] * 0x165667B19E3779F9 + code[k + 2] + 7) % big))
    return out


def plain_ftrl(texts, labels, how):
    """FTRL-proximal, coordinate by coordinate, in dictionaries; slot 0 is the bias without a penalty."""
    share = sum(labels) / len(labels)
    weight = {1: max(1.0, (1 - share) / share), 0: max(1.0, share / (1 - share))}
    z, n = defaultdict(float), defaultdict(float)

    def w(i):
        l1 = 0.0 if i == 0 else how.l1
        return 0.0 if abs(z[i]) <= l1 else (math.copysign(l1, z[i]) - z[i]) / ((how.beta + math.sqrt(n[i])) / how.alpha + how.l2)

    rows = [plain_features(t, how) | {0} for t in texts]
    for epoch in range(how.epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            g = (1 / (1 + math.exp(-sum(map(w, rows[k])))) - labels[k]) * weight[labels[k]]
            for i, old in [(i, w(i)) for i in rows[k]]:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / how.alpha * old
                n[i] += g * g
    return {i: w(i) for i in z if w(i)}


def test_op3_against_plain_training_and_scores(spark):
    how = toxicity.Model(bits=16, epochs=3, l1=0.5)
    bad, good = ["you are a vile idiot", "vile idiot go away you fool", "such a fool and idiot"], ["the sun is over the sea", "we go home by the sea", "the way is long", "rain over the way home"]
    texts, labels = [*bad, *good], [1] * 3 + [0] * 4
    at, weights = toxicity._train(texts, labels, how)
    want = plain_ftrl(texts, labels, how)
    assert set(at.tolist()) == set(want)
    assert all(abs(w - want[i]) < 1e-9 for i, w in zip(at.tolist(), weights.tolist(), strict=True))
    asked = [*texts, "", None, "idiot idiot sea", "x " * 5000 + "idiot"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, {"at": at, "w": weights}, how).collect()}
    for i, t in enumerate(asked):
        margin = want.get(0, 0.0) + sum(want.get(x, 0.0) for x in plain_features(t or "", how) - {0})
        assert abs(found[i] - 1 / (1 + math.exp(-margin))) < 1e-9


# --- sharding ----------------------------------------------------------------------------------------

def plain_tree(points, shards):
    """Parts of points (axes, tie, size, row), cut where half of the shards' bytes are nearest."""
    whole = [(min(p[0][a] for p in points), max(p[0][a] for p in points)) for a in range(4)]

    def cut(own, k):
        if k == 1 or not own:
            return [own]
        width = lambda a: (max(p[0][a] for p in own) - min(p[0][a] for p in own)) / max(1, whole[a][1] - whole[a][0])
        axis = max(range(4), key=width)
        sums = defaultdict(int)
        for p in own:
            sums[p[0][axis], p[1]] += p[2]
        total, under = sum(sums.values()), 0
        aim = total * (k // 2) / k
        for edge in sorted(sums):
            if under + sums[edge] >= aim:
                past = under + sums[edge] - aim < aim - under or under == 0
                break
            under += sums[edge]
        left = [p for p in own if (p[0][axis], p[1]) < edge or (past and (p[0][axis], p[1]) == edge)]
        right = [p for p in own if p not in left]
        n = min(k - 1, max(1, round(k * sum(p[2] for p in left) / total)))
        return cut(left, n) + cut(right, k - n)

    return cut(points, shards)


@pytest.mark.parametrize("shards", [3, 8])
def test_op5_against_a_plain_tree(spark, shards):
    texts = [("ab " * (k % 9 + 1) + "\n" * (k % 3) + "ä" * (k % 5) + str(k // 2)) for k in range(60)] + ["same"] * 25 + ["", None, None]
    docs = spark.createDataFrame([(i if i % 11 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    points = []
    for i, t in enumerate(texts):
        t = t or ""
        per = lambda n, t=t: n * 10_000 // len(t) if t else 0
        points.append(((len(t.encode()), per(len(t.encode())), per(t.count("\n")), per(t.count(" "))), zlib.crc32(t.encode()), len(t.encode()) + 1, i))
    found = defaultdict(list)
    for r in sharding.shard(docs, shards).collect():
        found[r["shard"]].append(r["text_crc32"])
    want = [sorted(p[1] for p in part) for part in plain_tree(points, shards)]
    assert sorted(map(sorted, found.values())) == sorted(w for w in want if w)


# --- fingerprints ------------------------------------------------------------------------------------

def test_op1_is_the_same_for_any_ranges(spark, monkeypatch):
    rows = [(7 * i % 40 if i % 13 else None, f"text {i} " * (i % 6) if i % 9 else None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    run = lambda pieces: sorted(map(repr, simhash.edited_fingerprints(docs, pieces=pieces).collect()))
    one = run(2)
    assert run(7) == one
    monkeypatch.setattr(simhash, "MOST_CUTS", 3)
    assert run(9) == one
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    edited = sorted((t or "")[: len(t or "") - len(t or "") // 2] + (ordered[(k + 1) % 40][1] or "")[: len(t or "") // 2] for k, (_, t) in enumerate(ordered))
    import hashlib

    assert sorted(hashlib.sha256(e.encode()).hexdigest() for e in edited) == sorted(r["edited_sha256"] for r in simhash.edited_fingerprints(docs, pieces=5).collect())
