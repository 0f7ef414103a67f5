"""op10_lm against plain Python: every n-gram counts, with start signs, up to three words."""

import math
import re
import zlib
from collections import Counter

import pytest

from smoothway.llm import lm, queries

ORDER, BACKOFF = 3, 0.4
TEXTS = ["a b c a b d", "b c e, a b c", "z", None, "", "Once only here", "a b c a b d", "?!", "Ä b c"]


def _words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts, corpus):
    """(n_tokens, n_backed_off, log_prob) of each text."""
    grams, contexts = Counter(), Counter()
    for t in corpus:
        w = ["<s>"] * (ORDER - 1) + _words(t)
        for i in range(ORDER - 1, len(w)):
            for n in range(1, ORDER + 1):
                grams[tuple(w[i - n + 1 : i + 1])] += 1
                contexts[tuple(w[i - n + 1 : i])] += 1
    out = []
    for t in texts:
        w, total, backed = ["<s>"] * (ORDER - 1) + _words(t), 0.0, 0
        for i in range(ORDER - 1, len(w)):
            n = next((n for n in range(ORDER, 0, -1) if grams[tuple(w[i - n + 1 : i + 1])]), 1)
            total += math.log(max(1, grams[tuple(w[i - n + 1 : i + 1])]) / max(1, contexts[tuple(w[i - n + 1 : i])])) + (ORDER - n) * math.log(BACKOFF)
            backed += n < ORDER
        out.append((len(w) - ORDER + 1, backed, total))
    return out


def _same(found, texts, corpus):
    for i, (tokens, backed, log_prob) in enumerate(plain(texts, corpus)):
        r = found[i]
        assert (r["n_tokens"], r["n_backed_off"]) == (tokens, backed), i
        assert abs(r["log_prob"] - log_prob) < 2e-6, i
        if tokens:
            assert abs(r["perplexity"] / math.exp(-log_prob / tokens) - 1) < 1e-6
        else:
            assert r["perplexity"] is None


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_other_orders(spark, order, monkeypatch):
    monkeypatch.setattr("tests.llm.test_lm.ORDER", order)
    found = lm.backoff_scores(_docs(spark, TEXTS), corpus=_docs(spark, TEXTS[:4]), order=order)
    _same({r["doc_id"]: r for r in found.collect()}, TEXTS, TEXTS[:4])


@pytest.mark.parametrize("slices", [1, 3])
def test_every_ngram_of_three_words_counts(spark, slices):
    _same({r["doc_id"]: r for r in lm.backoff_scores(_docs(spark, TEXTS), slices=slices).collect()}, TEXTS, TEXTS)


def test_another_corpus_backs_off(spark):
    corpus = ["a b c d", "c a b", "z z z", "b c a", None]
    found = lm.backoff_scores(_docs(spark, TEXTS), corpus=_docs(spark, corpus))
    _same({r["doc_id"]: r for r in found.collect()}, TEXTS, corpus)


def test_op10_on_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in queries.op10_lm(spark, sf_dir).collect()}
    known = [r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    _same([found[r["doc_id"]] for r in rows], [r["text"] for r in rows], known)
    assert sum(r["n_backed_off"] for r in found.values()) > 1000
    assert 0 < len(known) < len(rows)


def test_repeated_and_null_ids_are_documents_of_their_own(spark):
    rows = [(1, "a b", 7), (1, "a b", 7), (None, "a c", None), (None, None, None), (2, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long")
    found = sorted(((r["doc_id"] or -1, r["n_tokens"], round(r["log_prob"], 5)) for r in lm.backoff_scores(docs).collect()))
    two = round(math.log(2 / 3), 5)
    assert found == [(-1, 0, 0.0), (-1, 2, round(math.log(1 / 3), 5)), (1, 2, two), (1, 2, two), (2, 0, 0.0)]


def test_frequent_contexts_are_joined_with_the_same_result(spark, monkeypatch):
    texts = ["a b c"] * 40 + ["a b d", "x y z"] * 3
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    monkeypatch.setattr(lm, "OFTEN", 0.05)
    docs = _docs(spark, texts)
    assert lm._frequent(docs.selectExpr("doc_id AS row", "text"), 3)
    _same({r["doc_id"]: r for r in lm.backoff_scores(docs).collect()}, texts, texts)
    some = lm.backoff_scores(docs, learn=docs["doc_id"] % 3 > 0)
    _same({r["doc_id"]: r for r in some.collect()}, texts, [t for k, t in enumerate(texts) if k % 3 > 0])


def test_contexts_are_frequent_by_their_rows_however_many_there_are(spark, monkeypatch):
    docs = _docs(spark, ["a b c"] * 40 + [f"w{k} x{k} y{k}" for k in range(400)]).selectExpr("doc_id AS row", "text")
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    monkeypatch.setattr(lm, "OFTEN", 1.0)
    assert not lm._frequent(docs, 3)
    monkeypatch.setattr(lm, "MOST_ROWS", 60)
    assert len(lm._frequent(docs, 3)) == 3  # what precedes a, b and c


def test_a_text_sends_each_ngram_once(spark):
    rows = spark.createDataFrame([(0, "a b a b a b a b", True), (1, "a b", False)], "row long, text string, known boolean")
    grams = lm.gram_rows(rows, 3, None, 1, None).collect()
    assert sorted((r["row"], r["times"], r["c2"] is None) for r in grams) == [(0, 1, True), (0, 1, True), (0, 3, True), (0, 3, True), (1, -1, False), (1, -1, False)]
    summed = lm.gram_rows(rows, 2, None, 1, None, summed=True).collect()
    assert {r["row"] for r in summed} == {None} and sum(r["times"] for r in summed) == 8


def test_words_have_their_own_hashes_in_pieces_of_any_size(monkeypatch):
    texts = ["Aa bb aA, x" * 9, None, "", "é9 " * 50 + "w" * 700, "?!", "bb"] + [f"w{k} ab{k}" for k in range(3000)]
    raw = [t if t is None else t.encode() for t in texts]
    hashes, sizes = lm._hashed(raw)
    assert sizes.tolist() == [len(_words(t)) for t in texts]
    said = [w for t in texts for w in _words(t)]
    assert len(set(zip(said, hashes.tolist(), strict=True))) == len(set(said)) == len(set(hashes.tolist()))
    monkeypatch.setattr(lm, "PIECE", 64)
    monkeypatch.setattr(lm._hashed, "tables", lm._tables())
    again = lm._hashed(raw)
    assert again[0].tolist() == hashes.tolist() and again[1].tolist() == sizes.tolist()


def _dealt(spark, texts, order, buckets=8):
    docs = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], "row long, text string, known boolean").repartition(3)
    slots, words = lm._frequents(docs, [3, 2, 1])
    deal = lm._Deal(order, slots, buckets, 1)
    return words, deal, lm._packs(docs, deal, 0, summed=False).collect()


def test_ngrams_are_dealt_in_packs_and_not_row_by_row(spark, monkeypatch):
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    texts = [f"w{k} x{k} y{k} z{k}" for k in range(3000)]
    words, deal, packs = _dealt(spark, texts, 3)
    assert words == 12000 and sum(p["n"] for p in packs) >= 12000
    assert len(packs) <= 8 * 3  # at most one for each bucket of a task, however many n-grams there are


@pytest.mark.parametrize("order", [3, 2, 1])
def test_what_is_frequent_is_spread_over_buckets_and_counted_in_each(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    monkeypatch.setattr(lm, "OFTEN", 0.02)
    texts = ["a b c"] * 3000 + [f"a b d{k}" for k in range(300)]
    _, deal, packs = _dealt(spark, texts, order)
    assert deal.often.any() and deal.grams.any()
    held = {}
    for p in packs:
        held.setdefault(p["bucket"], []).append(deal.unpacked(p["n"], p["pack"]))
    asked = [sum((e[0] >= 0).sum() for e in entries) for entries in held.values()]
    assert len(asked) == 8 and max(asked) <= 2 * sum(asked) / 8


def test_frequent_words_of_every_order_have_the_same_scores(spark, monkeypatch):
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    monkeypatch.setattr(lm, "OFTEN", 0.02)
    monkeypatch.setattr(lm, "PACKED", 50)
    texts = ["a b c"] * 60 + [f"a b c v{k % 7} a b v{k % 5} c a" for k in range(60)] + [f"b a u{k} a c b a b" for k in range(30)] + ["a " * 90]
    docs = _docs(spark, texts)
    some = lm.backoff_scores(docs, learn=docs["doc_id"] % 3 > 0)
    _same({r["doc_id"]: r for r in some.collect()}, texts, [t for k, t in enumerate(texts) if k % 3 > 0])


def test_sums_of_texts_grow_with_texts_and_not_with_buckets(spark):
    rows = spark.createDataFrame([(k, "a b c d e f g h i j" if k % 2 else f"x{k} y z", True) for k in range(200)], "row long, text string, known boolean")
    made = []
    for buckets in (2, 20):
        deal = lm._Deal(3, {3: (), -3: ()}, buckets, 1)
        found = lm._met(lm._packs(rows, deal, 0, summed=False), deal, None, 0, 0.4, 4)
        assert lm._added(found, 4).agg({"n_tokens": "sum", "row": "count"}).first().asDict() == {"sum(n_tokens)": 1300, "count(row)": 200}
        made.append(found.count())
    assert made[0] <= 2 * 4 and made[1] <= 20 * 4


@pytest.mark.parametrize("often", [0.02, 1.0])
def test_words_are_counted_as_contexts_and_ends_of_texts(spark, monkeypatch, often):
    monkeypatch.setattr(lm, "LOOKED_AT", 1)
    monkeypatch.setattr(lm, "OFTEN", often)
    monkeypatch.setattr(lm, "PACKED", 500)
    texts = ["a b c"] * 400 + [f"a b d{k} c a b" for k in range(50)] + ["z", "only", "", None, "?!"] + ["a"] * 100
    docs = spark.createDataFrame([(k, t, k % 5 > 0) for k, t in enumerate(texts)], "row long, text string, known boolean").repartition(3)
    slots, _ = lm._frequents(docs, [2, 1])
    two, one = (lm._Deal(k, slots, 8, parts) for k, parts in ((2, 2), (1, 1)))
    assert two.grams.any() == (often < 1)
    counts = Counter()
    for part in range(2):
        found = lm._met(lm._packs(docs, two, part, summed=True), two, one, 1, BACKOFF, 4)
        for p in found.filter(f"part <> {lm.SUMS}").collect():
            row, _, word, times = one.unpacked(p["n"], p["pack"])
            kept = (row == lm.WHOLE) & (p["bucket"] == 0)  # a sum of all words, which each bucket gets
            counts["all"] += times[kept].sum()
            kept = (row == lm.COUNT) & (~one.grams[lm._slot(lm._gram(lm.np.full(len(word), lm.NOTHING, dtype=lm.np.uint64), word))] | (p["bucket"] == 0))
            counts.update(dict(zip(word[kept].tolist(), [0] * kept.sum(), strict=True)))
            for w, n in zip(word[kept].tolist(), times[kept].tolist(), strict=True):
                counts[w] += n
    said = Counter(w for k, t in enumerate(texts) if k % 5 for w in _words(t))
    names = dict(zip(lm._hashed([w.encode() for w in said])[0].tolist(), said, strict=True))
    assert counts.pop("all") == sum(said.values())
    assert {names[w]: n for w, n in counts.items()} == said


def test_texts_are_not_read_again_for_single_words(spark, monkeypatch):
    orders, packs = [], lm._packs
    monkeypatch.setattr(lm, "_packs", lambda rows, deal, *rest, **more: orders.append(deal.order) or packs(rows, deal, *rest, **more))
    docs = _docs(spark, TEXTS)
    some = lm.backoff_scores(docs, learn=docs["doc_id"] < 4)
    _same({r["doc_id"]: r for r in some.collect()}, TEXTS, TEXTS[:4])
    assert orders == [3, 3, 3, 2, 2, 2]


def test_counts_of_words_may_be_beyond_32_bits():
    deal = lm._Deal(1, {1: (), -1: ()}, 2, 1)
    batch = deal.packed(0, *(lm.np.array(c, dtype=t) for c, t in (([lm.COUNT], "i8"), ([lm.NOTHING], "u8"), ([99], "u8"), ([1 << 33], "i8"))))
    entries = [e for n, pack in zip(*(batch.column(k).to_pylist() for k in (2, 3)), strict=True) for e in zip(*(c.tolist() for c in deal.unpacked(n, pack)), strict=True)]
    assert sorted(entries) == [(lm.WHOLE, 1, 0, 1 << 33)] * 2 + [(lm.COUNT, 1, 99, 1 << 33)]
