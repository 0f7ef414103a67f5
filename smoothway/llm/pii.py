"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

DataFrame expressions only. The patterns are possessive forms of the base patterns: they match the
same texts but never go back over a run of characters, so no text can make them slow or deep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.llm.store import spare

# Base kinds in their order, then the kinds that this method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "secret")
LOCAL = "[A-Za-z0-9._%+-]"
PATTERN = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])",
}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "secret": 0.4}
CONTEXT = {
    "email": r"\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"\b(?:ip|address|host|server|login)\b",
    "card": r"\b(?:card|credit|visa|mastercard|payment|karte|carte|tarjeta)\b",
    "phone": r"\b(?:phone|tel|telephone|call|mobile|fax|telefon|téléphone|teléfono)\b",
    "iban": r"\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"\b(?:ssn|social security|tax id)\b",
    "secret": r"\b(?:\w*token|\w*secret|\w*key|password|passwd)\b",
}
CONTEXT_BONUS, THRESHOLD, NEAR = 0.2, 0.5, 48
#: Elements of an array that are summed or kept apart from the rest, and code points in a piece of a text:
#: so no step walks along all of a long array or text for each of its elements.
RUN, PIECE = 256, 4096
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def _luhn(digits: Column) -> Column:
    digit = lambda i: F.substr(digits, -i, F.lit(1)).cast("int")
    doubled = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, digit(i)).otherwise(2 * digit(i) - F.when(digit(i) > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(iban: Column) -> Column:
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    at = lambda i: F.ascii(F.substr(turned, i, F.lit(1)))
    step = lambda acc, i: F.when(at(i) >= 65, (acc * 100 + at(i) - 55) % 97).otherwise((acc * 10 + at(i) - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: str, found: Column) -> Column:
    """Whether a proposed text is of its kind."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.concat(F.lit("0"), F.substr(F.ltrim(p, F.lit("0")), F.lit(1), F.lit(3))).cast("int") <= 255)
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        plain = F.replace(found, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), _mod97(plain)).otherwise(F.lit(False))
    return F.lit(True)


def _runs(array: Column) -> Column:
    """0, 1, ... up to the number of runs of an array, less one; none for an empty one."""
    none = F.array().cast("array<int>")
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.floor((F.size(array) - 1) / RUN).cast("int"))).otherwise(none)


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0), lambda a, x: a + x)


def _matches(rows: DataFrame, text: str, kind: str, into: str, own: list[str]) -> DataFrame:
    """Add all matches of a kind with their places in code points, confirmed and scored.

    Places are running sums of the lengths of gaps and matches: the sum of all runs before, and of
    what is before in the own run. Each step is a column of its own, or it would be made anew for
    each element. Nearby words are looked for in the gaps on both sides.
    """
    pairs, sizes, runs, before = own
    pattern, whole = PATTERN[kind], F.col(text)
    likely = {"email": F.contains(whole, F.lit("@")), "phone": F.contains(whole, F.lit("+"))}.get(kind, whole.rlike("[0-9a-f]{32}" if kind == "secret" else "[0-9]"))
    split = F.arrays_zip(F.split(whole, pattern, -1).alias("gap"), F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)).alias("found"))
    rows = rows.withColumn(pairs, F.when(likely, split).otherwise(F.lit([]).cast("array<struct<gap:string,found:string>>")))
    rows = rows.withColumn(sizes, F.transform(pairs, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["found"]), F.lit(0))))
    rows = rows.withColumn(runs, F.transform(_runs(F.col(sizes)), lambda k: _total(F.slice(sizes, k * RUN + 1, F.lit(RUN)))))
    rows = rows.withColumn(before, F.transform(runs, lambda _, k: _total(F.slice(runs, F.lit(1), k))))

    def placed(x: Column, i: Column) -> Column:
        first = F.floor(i / RUN).cast("int")
        start = F.get(before, first) + _total(F.slice(sizes, first * RUN + 1, i % RUN)) + F.length(x["gap"])
        near = F.lower(F.concat(F.right(x["gap"], F.lit(NEAR)), F.lit(" "), F.left(F.coalesce(F.get(pairs, i + 1)["gap"], F.lit("")), F.lit(NEAR // 2))))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        here = F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), (start + F.length(x["found"])).cast("int").alias("end"), score.alias("score"))
        return F.when(x["found"].isNotNull() & F.coalesce(_confirmed(kind, x["found"]), F.lit(False)), here)

    found = F.array_compact(F.transform(pairs, placed))
    return rows.withColumn(into, found if kind in BASE else F.filter(found, lambda s: s["score"] >= THRESHOLD)).drop(*own)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add an array of spans (kind, start, end in code points, score), by kind, then start.

    Spans of the base kinds that pass their checks are always kept; spans of the added kinds are
    kept from a score of 0.5. A null or empty text has no spans. Repeated rows and null ids are rows
    as any other; an empty table stays empty. An input column of the result's name is replaced, all
    others stay as they are, whatever their names.
    """
    kept = docs.drop(into)
    kinds = [*BASE, *ADDED]
    whole, *rest = spare(kept, "whole", "pairs", "sizes", "runs", "before", *kinds)
    each = kept.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    for kind, name in zip(kinds, rest[4:], strict=True):
        each = _matches(each, whole, kind, name, rest[:4])
    return each.withColumn(into, F.concat(*rest[4:])).drop(whole, *rest[4:])


def _joined(spans: Column, *more: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], *[F.round(s[m], 2).cast("string") for m in more])), ",")


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, all spans, and these
    with their scores. Null and empty texts have none; repeated rows and null ids are documents of
    their own; an empty table gives no rows; other columns are not looked at."""
    found = find_pii(docs.select(doc_id, text), text)
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = _joined(F.filter("pii", lambda s: s["kind"].isin(*BASE)))
    return found.select(doc_id, *[count(k) for k in BASE], F.sha2(base, 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), _joined(F.col("pii"), "score").alias("scores"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Put [KIND] in place of each span; of overlapping spans the first (the longest) counts.

    Other columns stay, whatever their names, but n_chars (if there) is counted anew where the text
    changes. Null texts stay null; repeated rows stay; an empty table stays empty.
    """
    spans, kept, pieces = spare(docs, "spans", "kept", "pieces")
    found = find_pii(docs, text, spans)
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))
    found = found.withColumn(spans, by_place)

    def keep(acc: Column, s: Column) -> Column:
        return F.when(s["start"] >= acc["at"], F.struct((-s["minus_end"]).alias("at"), F.concat(acc["out"], F.array(s)).alias("out"))).otherwise(acc)

    def keep_run(acc: Column, k: Column) -> Column:
        none = F.slice(spans, 1, 0)
        run = F.aggregate(F.slice(spans, k * RUN + 1, F.lit(RUN)), F.struct(acc["at"].alias("at"), none.alias("out")), keep)
        return F.transform(F.array(run), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))[0]

    apart = F.aggregate(_runs(F.col(spans)), F.struct(F.lit(0).alias("at"), F.slice(spans, 1, 0).alias("out")), keep_run, lambda acc: acc["out"])
    found = found.withColumn(kept, apart).withColumn(pieces, F.when(F.size(kept) > 0, F.regexp_extract_all(F.col(text), F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))))

    def between(start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        held = F.array_join(F.slice(pieces, first + 1, F.greatest(F.floor((end - 1) / PIECE).cast("int") - first + 1, F.lit(0))), "")
        return F.substr(held, start - first * PIECE + 1, F.greatest(end - start, F.lit(0)))

    def put(s: Column, i: Column) -> Column:
        begin = F.when(i > 0, -F.get(kept, i - 1)["minus_end"]).otherwise(0)
        return F.concat(between(begin, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    tail = between(-F.element_at(kept, -1)["minus_end"], F.length(text))
    built = F.concat(F.array_join(F.transform(kept, put), ""), tail)
    clean = {text: F.when(F.size(kept) > 0, built).otherwise(F.col(text))}
    out = found.withColumns(clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(kept) > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
