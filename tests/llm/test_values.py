"""Values on odd rows and against plain versions, for op1, op4, op6 and op9."""

import re

import public_tokenizers
import pytest
import xxhash

from smoothway.llm import decontam, packing, pii, queries, simhash, store

PATHS = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]


def plain_print(text):
    """SimHash: each different word votes with its length, eight at most, on the bits of its hash."""
    words = {w for w in re.split(r"[^\w]|_", (text or "").lower()) if w}
    votes, total = [0] * 64, 0
    for w in words:
        weight = min(len(w), simhash.MOST_WEIGHT)
        h = xxhash.xxh64_intdigest(w.encode(), seed=42)
        total += weight
        for k in range(64):
            votes[k] += weight * (h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * votes[k] > total)


def test_op1_prints_against_plain_votes(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in queries.op1_fingerprints(spark, sf_dir).collect()}
    for k, r in enumerate(rows):
        text, after = r["text"] or "", rows[(k + 1) % len(rows)]["text"] or ""
        cut = len(text) // 2
        assert int(found[r["doc_id"]]["fingerprint"], 16) == plain_print(text)
        assert int(found[r["doc_id"]]["edited_fingerprint"], 16) == plain_print(text[: len(text) - cut] + after[:cut])


def test_op1_odd_rows(spark):
    rows = [(3, "same words"), (3, "same words"), (1, None), (2, ""), (None, "no id"), (4, "?!"), (5, "long word " * 30_000)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, print int")
    found = simhash.edited_fingerprints(docs).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"], int(r["fingerprint"], 16)) for r in found) == sorted((k or -1, len(t or ""), plain_print(t)) for k, t in rows)
    order = [None, 1, 2, 3, 3, 4, 5]
    texts = ["no id", "", "", "same words", "same words", "?!", rows[-1][1]]
    by = sorted(found, key=lambda r: (r["doc_id"] or -1))
    for k, r in enumerate(by):
        assert r["doc_id"] == order[k]
        same = 1 - (plain_print(texts[k]) ^ plain_print(texts[(k + 1) % 7])).bit_count() / 64
        assert r["near_next"] == pytest.approx(same) or order[k] == 3  # of two equal rows one comes first
    assert simhash.edited_fingerprints(docs.limit(0)).collect() == []


def test_near_counts_for_any_radius(spark):
    prints = [0, 1, 3, 7, 1 << 63, (1 << 63) | 3, 0b11111, 0, -1]
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed] + [(None,)], "fingerprint long")
    for radius, blocks in ((0, 2), (1, 3), (2, 5), (5, 8), (6, 9)):
        found = {r["fingerprint"]: r["near_count"] for r in simhash.near_counts(table, table, radius=radius, blocks=blocks).collect()}
        want = {p: sum(((p ^ q) & (1 << 64) - 1).bit_count() <= radius for q in signed) for p in signed}
        assert found == want


def test_op4_odd_rows(spark):
    rows = [(1, "two words"), (1, "two words"), (2, None), (3, ""), (None, "x"), (4, "word " * 5000)]
    docs = spark.createDataFrame([(k, t, 7, 7) for k, t in rows], "doc_id long, text string, piece int, length int")
    found = packing.packed(docs, *PATHS, keep_ids=True).collect()
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATHS[0])
    ids = lambda t: [*whole.encode(t or "", add_special_tokens=False).ids, 0]
    texts = {}
    for r in sorted(found, key=lambda r: (r["doc_id"] or -1, r["piece"], r["sequence_id"], r["offset"])):
        texts.setdefault((r["doc_id"], r["piece"]), []).append((r["start"], list(r["ids"])))
    assert [len(v) for k, v in texts.items() if k[0] == 1] == [2]
    assert all(p == ids("two words") for _, p in texts[1, 0])
    assert texts[2, 0] == texts[3, 0] == [(0, [0])] and texts[None, 0] == [(0, ids("x"))]
    long = [texts[4, k][0] for k in range(sum(k[0] == 4 for k in texts))]
    assert [x for _, p in long for x in p] == ids(rows[-1][1]) and [len(p) for _, p in long[1:]] == [2048] * (len(long) - 1)
    assert packing.packed(docs.limit(0), *PATHS).collect() == []


def test_op6_odd_rows(spark):
    rows = [(1, "One, TWO three"), (1, "One, TWO three"), (2, None), (3, ""), (None, "x one two three y"), (4, "?!"), (5, "two three"), (6, "pad " * 20_000 + "é ß one two three")]
    docs = spark.createDataFrame([(k, t, 1, 1) for k, t in rows], "doc_id long, text string, n_words int, leak int")
    items = spark.createDataFrame([(7, "one two three"), (7, "one two three"), (8, None), (None, "two three"), (9, ""), (10, "É SS")], "item_id long, text string")
    for size in (1 << 20, 1):
        found = sorted(((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["n_items"], r["contaminated"], r["items_sha256"]) for r in decontam.contamination(docs, items, block_bytes=size).collect()), key=str)
        hit, none = decontam.digest(["7"]), decontam.digest([])
        assert found == sorted([(1, 3, 3, 1, True, hit)] * 2 + [(2, 0, 0, 0, False, none), (3, 0, 0, 0, False, none), (-1, 5, 3, 1, True, hit), (4, 0, 0, 0, False, none), (5, 2, 0, 0, False, none), (6, 20_005, 3, 1, True, hit)], key=str)
        assert decontam.contamination(docs.limit(0), items, block_bytes=size).collect() == []
        assert decontam.contamination(docs, items.limit(0), block_bytes=size).filter("contaminated").isEmpty()
        kept = decontam.decontaminate(docs, items, block_bytes=size)
        assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5]


HEX = "0123456789abcdef" * 2


def test_op9_context_moves_a_score_across_the_threshold(spark):
    rows = [(1, f"sha {HEX}"), (2, f"api_key: {HEX}"), (3, "nr 123-45-6789"), (4, "his SSN: 123-45-6789"), (5, "a@b.co"), (6, "write to a@b.co"), (7, "4111 1111 1111 1111 is my card"), (8, f"{HEX} was the password"), (9, f"my token {'far ' * 20} {HEX}")]
    found = {r["doc_id"]: (r["spans"], r["scores"]) for r in pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] == found[3] == found[9] == ("", "")
    assert found[2] == ("secret:9:41", "secret:9:41:0.6")
    assert found[4] == ("ssn:9:20", "ssn:9:20:0.6")
    assert found[5][1] == "email:0:6:0.8" and found[6][1] == "email:9:15:1.0"
    assert found[7][1] == "card:0:19:1.0"
    assert found[8][1] == "secret:0:32:0.6"


def test_op9_odd_rows(spark):
    rows = [(1, "mail a@b.co"), (1, "mail a@b.co"), (2, None), (3, ""), (None, "😀 call +49 30 1234567"), (4, "x " * 50_000 + "1.2.3.4")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, pii int")
    found = sorted((r["doc_id"] or -1, r["spans"]) for r in pii.pii_report(docs).collect())
    assert found == [(-1, "phone:7:21"), (1, "email:5:11"), (1, "email:5:11"), (2, ""), (3, ""), (4, "ip:100000:100007")]
    kept = pii.redact(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.filter("doc_id < 4 or doc_id is null").collect()) == ["", "", "mail [EMAIL]", "mail [EMAIL]", "😀 call [PHONE]"]
    assert pii.pii_report(docs.limit(0)).collect() == []


def test_new_operators_on_one_odd_table(spark):
    from smoothway.llm import huffman, periodic

    docs = store.written(spark.createDataFrame([(1, "a b " * 9, 1), (None, None, 2), (1, "a b " * 9, 1)], "doc_id long, text string, start int"), "odd")
    assert periodic.collapse(periodic.planted(docs)).count() == huffman.stored(docs, store.place(spark, "odd-files"), *PATHS).count() == 3
