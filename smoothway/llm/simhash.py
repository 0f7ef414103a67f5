"""Document fingerprints: SimHash of weighted terms, and permuted block tables to find near ones.

DataFrame expressions only.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smoothway.llm.store import written

#: Bits of a fingerprint, the radius in which others are near, and the blocks that the tables permute.
#: Of true near copies (five-word Jaccard of 0.8 or more) some 0.94 lie within 6 bits, 0.56 within 3; of
#: texts that have nothing in common one pair in 10,000 differs in 17 or less. A key has 21 bits.
BITS, RADIUS, BLOCKS = 64, 6, 9
#: Bytes of text in a range of ids, and cuts that one step of finding them makes.
RANGE_BYTES, MOST_CUTS = 4 << 20, 1000
TOKEN = r"[^\p{L}\p{N}]+"
#: A word weighs as many votes as it has letters, up to this; longer words are rarer.
MOST_WEIGHT = 8
LOW = 0x0000000100000001


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN), lambda w: w != "")


def terms(words: Column) -> Column:
    """Weighted term hashes of a text: each of its words, once, however often the text has it.

    words must be a column that is there already, or it would be made anew for each term.
    """
    return F.transform(F.array_distinct(words), lambda a: F.struct(F.xxhash64(a).alias("h"), F.least(F.length(a), F.lit(MOST_WEIGHT)).cast("long").alias("w")))


def _votes(h: Column, w: Column) -> list[Column]:
    """Sums of votes: two bits of the hash in the two halves of each number, then all votes."""
    return [F.sum(F.shiftright(h, k).bitwiseAND(F.lit(LOW)) * w).alias(f"_v{k}") for k in range(32)] + [F.sum(w).alias("_all")]


def _fingerprint() -> Column:
    """Bit k is set if more than half of all votes have it; no votes give 0."""
    half = F.coalesce(F.col("_all"), F.lit(0))
    low = [F.when(F.col(f"_v{k}").bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > half, F.lit(1 << k)).otherwise(F.lit(0)) for k in range(32)]
    high = [F.when(F.shiftrightunsigned(f"_v{k}", 32) * 2 > half, F.lit((1 << 31) if k == 31 else 1 << k)).otherwise(F.lit(0)) for k in range(32)]
    pack = lambda bits: reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])
    return pack(low).bitwiseOR(F.shiftleft(pack(high), 32))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _masks(radius: int, blocks: int) -> list[int]:
    """Masks of the permuted tables: of the blocks, all but radius agree for near fingerprints."""
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    return [signed(sum(c)) for c in combinations(block, blocks - radius)]


def near_counts(prints: DataFrame, queries: DataFrame, fingerprint: str = "fingerprint", radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """For each distinct fingerprint in queries: how many rows of prints lie within the radius.

    Equal fingerprints are one row with a count before any table is built. Two fingerprints within
    the radius agree in at least blocks - radius blocks, so they meet in a table keyed by these
    blocks; they are compared in the first such table only. Exact for any radius < blocks.
    """
    masks = _masks(radius, blocks)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("m")) for t, m in enumerate(masks)])
    keyed = lambda df, name: df.select("*", F.explode(tables).alias("_k")).select("*", F.col("_k.t").alias(f"{name}_t"), F.col(name).bitwiseAND(F.col("_k.m")).alias(f"{name}_key")).drop("_k")
    known = keyed(prints.filter(F.col(fingerprint).isNotNull()).groupBy(F.col(fingerprint).alias("_fp")).agg(F.count("*").alias("_n")), "_fp")
    asked = keyed(queries.select(F.col(fingerprint).alias("_q")).dropna().distinct(), "_q").hint("merge")  # grows with the table: never broadcast
    apart = F.col("_fp").bitwiseXOR(F.col("_q"))
    first = reduce(lambda rest, tm: F.when(apart.bitwiseAND(F.lit(tm[1])) == 0, F.lit(tm[0])).otherwise(rest), reversed(list(enumerate(masks))), F.lit(-1))
    met = known.join(asked, (F.col("_fp_t") == F.col("_q_t")) & (F.col("_fp_key") == F.col("_q_key")) & (F.bit_count(apart) <= radius) & (first == F.col("_q_t")))
    return met.groupBy(F.col("_q").alias(fingerprint)).agg(F.sum("_n").alias("near_count"))


def _upto(cuts: Column, ident: Column) -> Column:
    """How many of the sorted cuts are up to an id, found in two steps of about the root of their number."""
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(cuts))).cast("int"))
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(1), step), lambda k: F.get(cuts, k * step - 1)), lambda b: b <= ident)) * step
    return coarse + F.size(F.filter(F.slice(cuts, coarse + 1, step), lambda b: b <= ident))


def _cuts(ids: DataFrame, pieces: int, by: list[str]) -> DataFrame:
    """Ids that cut the rows of each `by` into pieces of about even weight, as a column cuts."""
    shares = [k / pieces for k in range(1, pieces)] or [0.5]
    return ids.groupBy(*by).agg(F.percentile_approx("id", shares, 20 * pieces).alias("cuts"))


def ranges(rows: DataFrame, ident: str, text: str, pieces: int | None) -> tuple[DataFrame, tuple[int, int | None, int]]:
    """rows with the columns _range (a number, ascending with the id, 0 for a null id) and _starts
    (whether the id is the least of its range), and the last range, the least id and how many are null.

    Ranges hold about RANGE_BYTES of text, whatever the number of rows or shuffle partitions. They are
    cut in two steps of at most MOST_CUTS each, so a plan or broadcast holds no more than these.
    """
    ids = rows.select(F.col(ident).cast("long").alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    told = ids.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("id").alias("least"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    pieces = min(MOST_CUTS**2, pieces or max(2, -(-(told["bytes"] or 0) // RANGE_BYTES)))
    mean = max(1, (told["bytes"] or 0) // max(1, told["rows"]))
    # an id counts once, and once more for each mean length of its text
    weighted = ids.filter("id is not null").select("id", F.explode(F.sequence(F.lit(1), F.lit(1) + F.least(F.lit(1_000), F.floor(F.col("bytes") / mean)).cast("int"))))
    first = sorted(set(_cuts(weighted, min(pieces, MOST_CUTS), []).first()["cuts"] or []))
    finer, fine = -(-pieces // MOST_CUTS), {}
    where = _upto(F.lit(first).cast("array<bigint>"), F.col("id"))
    if finer > 1:
        fine = {r["part"]: r["cuts"] for r in _cuts(weighted.withColumn("part", where), finer, ["part"]).collect()}
    table, number = [], 0
    for part in range(len(first) + 1):
        own = sorted({c for c in fine.get(part, []) if not part or c > first[part - 1]})
        table.append((part, own, number, first[part - 1] if part else None))
        number += len(own) + 1
    cuts = F.broadcast(rows.sparkSession.createDataFrame(table, "_part int, _cuts array<bigint>, _first int, _low bigint"))
    at = F.coalesce(_upto(F.lit(first).cast("array<bigint>"), F.col(ident).cast("long")), F.lit(0))
    placed = rows.withColumn("_part", at).join(cuts, "_part").withColumn("_k", F.coalesce(_upto(F.col("_cuts"), F.col(ident).cast("long")), F.lit(0)))
    lowest = F.when(F.col("_k") > 0, F.get("_cuts", F.col("_k") - 1)).otherwise(F.col("_low"))
    placed = placed.withColumns({"_range": F.col("_first") + F.col("_k"), "_starts": F.coalesce(lowest == F.col(ident).cast("long"), F.lit(False))})
    return placed.drop("_part", "_cuts", "_first", "_low", "_k"), (number - 1, told["least"], told["nulls"])


def with_next(docs: DataFrame, doc_id: str, text: str, pieces: int | None = None) -> DataFrame:
    """Rows (range, late, doc_id, text) in which the next row of a range is the next document.

    The first rows of a range are also sent, as guests with late = 1, to the range before it, and the
    first row of all, with late = 2, to the last. So no task need hold more than a range, and the
    texts are shuffled once.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed, (last, least, nulls) = ranges(rows, "id", "text", pieces)
    places = F.array_compact(F.array(F.struct(F.col("_range").alias("range"), F.lit(0).alias("late")), F.when(F.col("_starts"), F.struct((F.col("_range") - 1).alias("range"), F.lit(1).alias("late")))))
    dealt = placed.select("id", "text", F.explode(places).alias("_at")).select("_at.range", "_at.late", "id", "text")
    first = rows.filter(F.col("id").isNull() if nulls else F.col("id") == F.lit(least))
    head = first.select(F.lit(last).alias("range"), F.lit(2).alias("late"), "id", "text").orderBy("text").limit(1)
    return dealt.unionByName(head)


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 50, radius: int = RADIUS, pieces: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last half replaced by the start of the next document's text (ascending
    integer id, then text; after the last document comes the first). Rows with a null id come first;
    a null text is empty; repeated rows are documents of their own. near_count, for ids divisible by
    every, is the number of documents (itself included) within the radius; it is null for others. An
    empty table gives no rows; other columns are not looked at.
    """
    order = Window.partitionBy("range").orderBy("late", F.asc_nulls_first("id"), "text")
    chars = F.char_length("text")
    cut = F.floor(chars / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), chars - cut), F.substr("next", F.lit(1), cut))
    placed = with_next(docs, doc_id, text, pieces).withColumn("next", F.coalesce(F.lead("text").over(order), F.lit(""))).withColumn("place", F.row_number().over(order))
    texts = placed.select("range", "late", "place", "id", chars.cast("long").alias("n_chars"), "text", edited.alias("edited")).withColumn("sha", F.sha2("edited", 256))
    parts = [F.conv(F.substr("sha", F.lit(1 + 16 * k), F.lit(16)), 16, -10).cast("long").alias(f"_s{k}") for k in range(4)]
    both = texts.select("range", "late", "place", "id", "n_chars", *parts, F.explode(F.array(F.struct(F.lit(0).alias("of"), F.col("text").alias("t")), F.struct(F.lit(1).alias("of"), F.col("edited").alias("t")))).alias("_x"))
    kept = [F.max(c).alias(c) for c in ("id", "n_chars", *[f"_s{k}" for k in range(4)])]
    facts = ["range", "late", "place", "id", "n_chars", *[f"_s{k}" for k in range(4)]]
    split = both.select(*facts, "_x.of", words(F.col("_x.t")).alias("_words"))
    votes = split.select(*facts, "of", F.explode_outer(terms(F.col("_words"))).alias("_t"))
    prints = votes.groupBy("range", "late", "place", "of").agg(*kept, *_votes(F.col("_t.h"), F.col("_t.w"))).withColumn("print", _fingerprint())
    of = lambda k, c: F.max(F.when(F.col("of") == k, F.col(c)))
    each = prints.groupBy("range", "late", "place").agg(of(0, "id").alias("id"), of(0, "n_chars").alias("n_chars"), *[of(0, f"_s{k}").alias(f"_s{k}") for k in range(4)], of(0, "print").alias("own"), of(1, "print").alias("changed"))
    after = each.withColumn("following", F.lead("own").over(Window.partitionBy("range").orderBy("late", "place"))).filter("late = 0")
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    table = written(
        after.select(
            F.col("id").alias(doc_id),
            "n_chars",
            F.concat(*[hexed(f"_s{k}") for k in range(4)]).alias("edited_sha256"),
            F.col("own").alias("print"),
            hexed("own").alias("fingerprint"),
            hexed("changed").alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        ),
        "fingerprints",
    )
    asked = F.coalesce(F.col(doc_id) % every == 0, F.lit(False))
    counts = near_counts(table, table.filter(asked), "print", radius)
    told = table.filter(asked).join(counts, "print", "left")
    return told.unionByName(table.filter(~asked).withColumn("near_count", F.lit(None).cast("long"))).drop("print")
