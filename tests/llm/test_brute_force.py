"""Operators that SQL can't express against plain Python on the given tables."""

import hashlib
import re
import zlib

import public_tokenizers
from pyspark.sql import functions as F

from smoothway.llm import decontam, packing, pii, queries, simhash

PATHS = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]


def _docs(spark, sf_dir):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def test_op1_edits_and_likeness(spark, sf_dir):
    docs, found = _docs(spark, sf_dir), {r["doc_id"]: r for r in queries.op1_fingerprints(spark, sf_dir).collect()}
    prints = {i: int(r["fingerprint"], 16) for i, r in found.items()}
    for k, (i, text) in enumerate(docs):
        j, after = docs[(k + 1) % len(docs)]
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(found[i]["near_next"] - (1 - (prints[i] ^ prints[j]).bit_count() / 64)) < 1e-12
        changed = int(found[i]["edited_fingerprint"], 16)
        assert abs(found[i]["near_edited"] - (1 - (prints[i] ^ changed).bit_count() / 64)) < 1e-12
    for i, r in found.items():
        if i % 50 == 0:
            assert r["near_count"] == sum((prints[i] ^ p).bit_count() <= simhash.RADIUS for p in prints.values())
    of = {}
    for i, text in docs:
        assert of.setdefault(text, prints[i]) == prints[i]


def luhn(digits):
    return sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_op9_base_spans(spark, sf_dir):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    found = {r["doc_id"]: r for r in queries.op9_pii(spark, sf_dir).collect()}
    for i, text in _docs(spark, sf_dir):
        spans = {k: [m.span() for m in re.finditer(p, text) if good(m[0])] for k, (p, good) in kinds.items()}
        listed = ",".join(f"{k}:{a}:{b}" for k, own in spans.items() for a, b in own)
        assert found[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), i
        assert [found[i][f"n_{k}"] for k in kinds] == [len(own) for own in spans.values()]
        assert set(filter(None, listed.split(","))) <= set(found[i]["spans"].split(","))


def test_pii_added_kinds_and_redaction(spark):
    rows = [(1, "pay to account DE89370400440532013000 now"), (2, "pay to account DE89370400440532013001 now"), (3, "ssn 123-45-6789, mail a@b.co"), (4, None), (5, "4111 1111 1111 1111")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.pii_report(docs).collect()}
    assert spans[1] == "iban:15:37" and spans[2] == "" and spans[3] == "email:22:28,ssn:4:15" and spans[5] == "card:0:19"
    texts = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert texts == {1: "pay to account [IBAN] now", 2: rows[1][1], 3: "ssn [SSN], mail [EMAIL]", 4: None, 5: "[CARD]"}


def test_op4_ids_and_sequences(spark, sf_dir):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATHS[0])
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in _docs(spark, sf_dir)}
    pieces, sequences = {}, {}
    for r in queries.op4_packing(spark, sf_dir).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            part = ids[i][at : at + r["length"]]
            assert (r["piece"], r["start"], len(part)) == (k, at, r["length"])
            assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            at += r["length"]
        assert at == len(ids[i])
        assert all(r["length"] == 2048 for r in own[1:])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(map(len, ids.values())) // 2048)
    assert len(sequences) <= 1.02 * least + 1


def test_minimum_bin_slack_fills_exactly():
    assert packing.minimum_bin_slack({6: 2, 4: 1, 3: 2, 1: 1}, 10) == [({6: 1, 4: 1}, 1), ({6: 1, 3: 1, 1: 1}, 1), ({3: 1}, 1)]


def test_op5_is_a_partition_by_bytes(spark, sf_dir):
    found = queries.op5_sharding(spark, sf_dir).collect()
    texts, sizes, slots, of = dict(_docs(spark, sf_dir)), [0] * 8, {}, {}
    for r in found:
        text = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 1, zlib.crc32(text), "bytes")
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert of.setdefault(text, r["shard"]) == r["shard"]
    assert len(found) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t) + 1 for t in of)
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes) + 2 * largest


def test_op2_and_op3_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest table has five toxic rows in the held-out fold
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = queries.op2_language(spark, sf_dir).filter("held_out and lang_pred <> 'und'").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null")
    right = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = queries.op3_toxicity(spark, sf_dir).join(labels, "doc_id").filter("held_out").select("score", "toxic").collect()
    toxic, clean = [r["score"] for r in scored if r["toxic"]], [r["score"] for r in scored if not r["toxic"]]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert wins / max(1, len(toxic) * len(clean)) > 0.9


def test_op8_article_of_a_page(spark):
    from smoothway.llm import html

    page = "<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><article><h1>Name &amp; place</h1><p>First   words of\nthe article that say enough to count as text.</p></article><footer>Imprint and contact</footer><script>x()</script></body></html>"
    docs = spark.createDataFrame([(1, "u", page), (2, "v", None), (3, "w", "<p>unclosed <b>words"), (4, "x", "")], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in html.extract(docs).collect()}
    assert found[1]["text"] == "Name & place\nFirst words of the article that say enough to count as text."
    assert found[2]["text"] == "" and found[4]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_op6_in_any_number_of_blocks(spark, sf_dir):
    """Blocks of test items change no row; each is scanned by itself, so a stage has one Python process a task."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = lambda df: sorted(map(repr, df.collect()))
    whole = decontam.contamination(docs, items)
    bytes_all = items.agg(F.sum(F.octet_length("text"))).first()[0]
    blocks = []
    scanned = decontam._scanned
    decontam._scanned = lambda d, block, *a: blocks.append(block) or scanned(d, block, *a)
    try:
        parted = decontam.contamination(docs, items, block_bytes=bytes_all // 30)
    finally:
        decontam._scanned = scanned
    assert len(blocks) > 20
    plan = parted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") <= 2  # the merge of the written hits, not a chain of scans
    assert rows(parted) == rows(whole)
    assert parted.filter("contaminated").count() >= 3
    kept = lambda **o: rows(decontam.decontaminate(docs, items, remove="spans", **o))
    assert kept(block_bytes=bytes_all // 4) == kept()
