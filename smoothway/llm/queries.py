"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smoothway.llm import decontam, html, huffman, jaccard, langid, lm, packing, periodic, pii, sharding, simhash, store, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    store.tune(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(_read(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]
    return packing.packed(_read(spark, sf_dir, "documents"), *paths)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("spans")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_read(spark, sf_dir, "documents"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model learns from three folds of four and scores all documents."""
    return lm.backoff_scores(_read(spark, sf_dir, "documents"), learn=store.fold("doc_id", 4) != 2)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    return found.withColumns({"deviation": F.col("deviation").try_cast("long"), "deviation_exact": F.col("deviation")})


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(periodic.planted(_read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    rows = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    own = {"start": -F.col("best.back"), "length": F.col("best.length"), "period": -F.col("best.short"), "exponent_milli": F.expr("1000 * best.length div -best.short")}
    return rows.select("doc_id", "n_runs", *[c.alias(n) for n, c in own.items()], "runs_sha256", "collapsed_sha256", "n_words")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]
    return huffman.stored(_read(spark, sf_dir, "documents"), store.place(spark, "token-files"), *paths)


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_language, op3_toxicity, op4_packing, op5_sharding, op6_decontamination, op7_jaccard, op8_html, op9_pii, op10_lm, op11_whitening, op12_runs, op13_token_files)}

_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{p}')"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str = _PLAIN) -> str:
    return f"coalesce({_WORDS.format(t=text, p=pattern)}, [])"


#: crc32 of the decimal doc_id, and a logarithm as a whole number of 1e-9.
_CRC = "xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(unicode(d) AS BIGINT)), lambda c, d: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, d)), CAST(4294967295 AS BIGINT)), 4294967295)"
_LN = "CAST(round(ln({}) / CAST(1e-9 AS DOUBLE)) AS BIGINT)"


#: SQL of the queries that SQL can express. The others train models, tokenize or hash as Spark does.
ORACLES: dict[str, str] = {
    "op6_decontamination": f"""WITH item AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_words("text")} AS w FROM benchmark) WHERE len(w) > 0),
 win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM item)),
 doc AS (SELECT doc_id, {_words("text")} AS w FROM documents), place AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM win)),
 met AS (SELECT doc_id, i, p.k, item_id FROM place p JOIN win ON p.k = win.k AND array_to_string(w[i:i + p.k - 1], ' ') = s),
 hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM met) GROUP BY 1),
 of AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY 1)
 SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(of.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN of USING (doc_id)""",
    "op7_jaccard": f"""WITH RECURSIVE doc AS (SELECT doc_id, {_words("text", "[^ \\x09-\\x0D]+")} AS w FROM documents),
 shingled AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM doc),
 token AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM shingled),
 link AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n + y.n) AS sizes, count(*) AS c FROM token x JOIN token y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2) WHERE 100 * c >= 80 * (sizes - c)),
 reach AS (SELECT a AS node, b AS other FROM link UNION SELECT reach.node, link.b FROM reach JOIN link ON reach.other = link.a)
 SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM shingled LEFT JOIN (SELECT node, min(other) AS m FROM reach GROUP BY 1) ON node = doc_id""",
    "op10_lm": f"""WITH doc AS (SELECT doc_id, {_CRC} % 4 <> 2 AS known, {_words("text")} AS w FROM documents),
 word AS (SELECT doc_id, known, s[i] AS a, s[i + 1] AS b, s[i + 2] AS c FROM (SELECT doc_id, known, list_concat(['', ''], w) AS s, unnest(range(1, len(w) + 1)) AS i FROM doc)),
 three AS (SELECT a, b, c, count(*) AS n3 FROM word WHERE known GROUP BY 1, 2, 3), of3 AS (SELECT a, b, sum(n3) AS o3 FROM three GROUP BY 1, 2), two AS (SELECT b, c, sum(n3) AS n2 FROM three GROUP BY 1, 2), of2 AS (SELECT b, sum(n2) AS o2 FROM two GROUP BY 1), one AS (SELECT c, sum(n2) AS n1 FROM two GROUP BY 1),
 scored AS (SELECT doc_id, n3 IS NULL AS lost, CASE WHEN n3 IS NOT NULL THEN {_LN.format("n3")} - {_LN.format("o3")} WHEN n2 IS NOT NULL THEN {_LN.format("n2")} - {_LN.format("o2")} + {_LN.format("0.4")} ELSE {_LN.format("coalesce(n1, 1)")} - {_LN.format("greatest(1, (SELECT coalesce(sum(n1), 0) FROM one))")} + 2 * {_LN.format("0.4")} END AS s
 FROM word LEFT JOIN three USING (a, b, c) LEFT JOIN of3 USING (a, b) LEFT JOIN two USING (b, c) LEFT JOIN of2 USING (b) LEFT JOIN one USING (c)),
 summed AS (SELECT doc_id, count(*) FILTER (lost) AS backed, CAST(sum(s) AS BIGINT) * CAST(1e-9 AS DOUBLE) AS lp FROM scored GROUP BY 1)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, coalesce(backed, 0) AS n_backed_off, round(coalesce(lp, 0), 6) AS log_prob, CASE WHEN len(w) > 0 THEN round(exp(-lp / len(w)), 6) END AS perplexity FROM doc LEFT JOIN summed USING (doc_id)""",
    "op12_runs": f"""WITH doc AS (SELECT doc_id, {_CRC} AS h, coalesce(regexp_extract_all(text, '[^ \\x09-\\x0D]+'), []) AS w, len(w) AS n FROM documents),
 cut AS (SELECT *, h // 10 % n AS a, 1 + (n - h // 10 % n) // (3 + h // 10 % 8) AS p FROM doc),
 said AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM cut),
 place AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS k FROM (SELECT *, unnest(range(0, n - 5)) AS i FROM said)),
 pair AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM place x JOIN place y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
 stretch AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q - min(i) AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS same FROM pair) GROUP BY doc_id, q, same),
 run AS (SELECT doc_id, s, n, min(q) AS q FROM stretch WHERE n >= greatest(12, 2 * q) GROUP BY 1, 2, 3),
 gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM run),
 kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS t, unnest(range(0, n)) AS i FROM said WHERE doc_id IN (SELECT doc_id FROM run)) ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
 told AS (SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'n': n, 'q': q}}, (-n, s, q)) AS best, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY 1)
 SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.n AS length, best.q AS period, 1000 * best.n // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, array_to_string(w, ' '))) AS collapsed_sha256, n AS n_words FROM said LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
