"""K-d tree sharding: leaves of near equal bytes, cut at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.llm.store import numbered, written

BINS = 1024
#: A cut is good enough where at most this share of the node's bytes lies between it and the aim.
TOLERANCE = 0.0005
TIE = "_tie"


@dataclass
class _Search:
    """A node of the tree and the state of the search for its cut: bins of [low, high) on an axis.

    fixed is set once the cut falls on rows of one value: they are then parted by _tie.
    """

    node: int
    shards: int
    total: int
    axis: int
    low: int
    high: int
    fixed: int | None = None
    below: int = 0
    cut: tuple[int, int | None] | None = None

    @property
    def aim(self) -> float:
        return self.total * (self.shards // 2) / self.shards

    def narrow(self, sums: dict[int, int]) -> None:
        """Go into the bin that the aim falls in, or settle."""
        at, under = min(sums, default=0), self.below
        for k in sorted(sums):
            at = k
            if under + sums[k] >= self.aim:
                break
            under += sums[k]
        width, inside = self.high - self.low, sums.get(at, 0)
        low = self.low + -(-at * width // BINS)
        high = self.low + -(-(at + 1) * width // BINS)
        fine = max(TOLERANCE * self.total, 1)
        if inside <= fine or (high - low <= 1 and self.fixed is not None):
            edge = high if under + inside - self.aim < self.aim - under or under == 0 else low
            self.cut = (self.fixed, edge) if self.fixed is not None else (edge, None)
        elif high - low <= 1:
            self.fixed, self.low, self.high, self.below = low, 0, 1 << 32, under
        else:
            self.low, self.high, self.below = low, high, under


def kd_tree(points: DataFrame, axes: list[str], size: str, shards: int) -> DataFrame:
    """points (a stored table) with a column node, the number of the leaf from 0 to shards - 1.

    points are integers without nulls, with a column _tie in [0, 2**32). A node with k shards is cut,
    along the axis on which it is widest as a share of the whole table's range, where half of its
    shards' bytes lie to the left. Rows equal on all axes and _tie are never parted. What is known
    of the nodes (at most as many as there are shards) is a small table that is joined to the rows,
    and each level writes the rows' nodes, so no plan grows with the number of shards. A pass sums at
    most BINS bins a node on the executors; that is all that comes back.
    """
    spark = points.sparkSession
    at = F.array(*[F.col(a) for a in axes])
    ranges = [x for a in axes for x in (F.min(a).alias(f"lo_{a}"), F.max(a).alias(f"hi_{a}"))]
    whole = points.agg(*ranges).first()
    now, nodes, leaves, fresh = points.withColumn("node", F.lit(0)), {0: shards}, [], 1
    while nodes:
        facts = {r["node"]: r for r in now.groupBy("node").agg(F.sum(size).alias("total"), *ranges).collect()}
        searches = []
        for n, k in nodes.items():
            if k == 1 or n not in facts:
                leaves += [n, *[None] * (k - 1)]  # without rows, further shards stay empty
                continue
            r = facts[n]
            axis = max(range(len(axes)), key=lambda a: (r[f"hi_{axes[a]}"] - r[f"lo_{axes[a]}"]) / max(1, whole[f"hi_{axes[a]}"] - whole[f"lo_{axes[a]}"]))
            searches.append(_Search(n, k, r["total"], axis, r[f"lo_{axes[axis]}"], r[f"hi_{axes[axis]}"] + 1))
        if not searches:
            break
        while open_ := [s for s in searches if s.cut is None]:
            asked = spark.createDataFrame([(s.node, s.axis, s.low, s.high, s.fixed) for s in open_], "node int, _axis int, _low long, _high long, _fixed long")
            met = now.join(F.broadcast(asked), "node").withColumn("_on", F.get(at, F.col("_axis")))
            value = F.when(F.col("_fixed").isNull(), F.col("_on")).when(F.col("_on") == F.col("_fixed"), F.col(TIE))
            met = met.withColumn("_v", value).filter("_v >= _low and _v < _high")
            found: dict[int, dict[int, int]] = {s.node: {} for s in open_}
            which = F.floor((F.col("_v") - F.col("_low")).cast("double") * BINS / (F.col("_high") - F.col("_low"))).cast("int")
            for r in met.groupBy("node", which.alias("bin")).agg(F.sum(size).alias("bytes")).collect():
                found[r["node"]][r["bin"]] = r["bytes"]
            for s in open_:
                s.narrow(found[s.node])
        cuts = spark.createDataFrame([(s.node, s.axis, *s.cut, fresh + 2 * k) for k, s in enumerate(searches)], "node int, _axis int, _value long, _part long, _next int")
        met = now.join(F.broadcast(cuts), "node", "left").withColumn("_on", F.get(at, F.col("_axis")))
        left = (F.col("_on") < F.col("_value")) | F.coalesce((F.col("_on") == F.col("_value")) & (F.col(TIE) < F.col("_part")), F.lit(False))
        side = F.when(F.col("_next").isNull(), F.col("node")).otherwise(F.col("_next") + F.when(left, 0).otherwise(1))
        now = written(met.withColumn("node", side).select(*points.columns, "node"), "nodes")
        weights = {r["node"]: r["w"] for r in now.groupBy("node").agg(F.sum(size).alias("w")).collect()}
        nodes = {}
        for k, s in enumerate(searches):
            one = fresh + 2 * k
            own = min(s.shards - 1, max(1, round(s.shards * weights.get(one, 0) / s.total)))
            nodes |= {one: own, one + 1: s.shards - own}
        fresh += 2 * len(searches)
    order = spark.createDataFrame([(n, k) for k, n in enumerate(leaves) if n is not None], "node int, _leaf int")
    return now.join(F.broadcast(order), "node").withColumn("node", F.col("_leaf")).drop("_leaf")


def _per(count: Column, chars: Column) -> Column:
    """A count for each 10,000 characters, whole."""
    return F.coalesce(F.floor(count * 10_000 / F.nullif(chars, F.lit(0))), F.lit(0)).cast("long")


def shard(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null).

    The axes are what is known of a text itself: its bytes, and its bytes, lines and blanks for each
    10,000 characters (script, layout, length of words); crc32 of the text parts rows that are alike
    on all. So documents with equal texts are in one shard, whatever their number. A null text has no
    bytes; size is bytes plus 1. With fewer distinct texts than shards some shards stay empty. Slots
    follow no order. Repeated rows and null ids are documents of their own; an empty table gives no
    rows; other columns are not looked at.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    chars = F.char_length(whole)
    without = lambda c: chars - F.char_length(F.replace(whole, F.lit(c), F.lit("")))
    points = written(
        docs.select(
            F.col(doc_id).alias("_id"),
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            F.crc32(whole).alias(TIE),
            F.octet_length(whole).cast("long").alias("_bytes"),
            _per(F.octet_length(whole), chars).alias("_script"),
            _per(without("\n"), chars).alias("_lines"),
            _per(without(" "), chars).alias("_blanks"),
        ),
        "points",
    )
    leaves = kd_tree(points, ["_bytes", "_script", "_lines", "_blanks"], "size", shards)
    dealt = written(leaves.select("_id", "size", F.col(TIE).alias("text_crc32"), F.col("node").alias("shard")), "dealt")
    placed = numbered(dealt, ["shard"], ["_id", "text_crc32", "size"], "slot")
    return placed.select(F.col("_id").alias(doc_id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
