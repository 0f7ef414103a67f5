"""Shared steps: written intermediate tables, distributed numbering, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes that reach a Python worker at once; very long texts then can't fill its memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "128", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


#: Shuffle files of a job that has ended are of no use to any other, as lineage ends with its table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for as long as a job runs; then the user's own are back."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tune(spark: SparkSession) -> None:
    """Bound what Arrow hands to a Python worker in one batch, for the session.

    For results that Spark makes only when the caller asks for them; written tables have these bounds anyway.
    """
    for k, v in BATCHES.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors see."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir") + "/_smoothway"
    return found.rstrip("/")


def clean(spark: SparkSession) -> None:
    """Delete all tables that operators of this process have written; what they returned is void then."""
    while _TABLES:
        _delete(spark, _TABLES.pop())


#: Tables that this process has written, for clean().
_TABLES: list[str] = []


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which clean() will delete."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage and shuffle files end there."""
    spark = df.sparkSession
    path = place(spark, name)
    with _settings(spark, {CLEANUP: "true", **BATCHES}):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete written tables from which all that is needed has been written in turn."""
    for table in tables:
        _delete(table.sparkSession, table.written_at)
        _TABLES.remove(table.written_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fields(rest: str, **given: T.DataType) -> T.StructType:
    """A schema: the given columns with their types, then those of a DDL string."""
    return T.StructType([T.StructField(n, k) for n, k in given.items()] + T.DataType.fromDDL(rest).fields)


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of a job's own that none of df's columns has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    return [next(n for k in range(len(taken) + 1) if (n := f"_{name}{k or ''}") not in taken) for name in names]


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id is in no fold (null)."""
    return F.crc32(F.col(id_column).cast("string")) % parts


def numbered(df: DataFrame, key: list[str], order: list[str], into: str, rows_per_chunk: int = 100_000) -> DataFrame:
    """Number the rows of each key from 0 without gaps; no task holds a whole key.

    Rows of a key are dealt to hashed chunks, numbered inside each chunk, and shifted by the sizes
    of the chunks before it. df must be a stored table (it is read twice).
    """
    chunks = max(1, -(-df.count() // rows_per_chunk))
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    sizes = dealt.groupBy(*key, "_chunk").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_chunk").alias("_shift_chunk"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = dealt.withColumn("_row", F.row_number().over(Window.partitionBy(*key, "_chunk").orderBy(*order)) - 1)
    on = within["_chunk"] == shifts["_shift_chunk"]
    for k in key:
        on = on & within[k].eqNullSafe(shifts[f"_k_{k}"])
    joined = within.join(shifts, on)
    return joined.withColumn(into, F.col("_row") + F.col("_shift")).drop("_chunk", "_row", "_shift", "_shift_chunk", *[f"_k_{k}" for k in key])


def components(edges: DataFrame, a: str, b: str, rounds: int = 40) -> DataFrame:
    """Connected components of undirected edges: one row (node, root) per node in any edge.

    Alternates large-star and small-star steps until the edges no longer change; each round is a
    written table, so a lost executor costs one round at most. root is the least node id reachable.
    """
    def digest(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()

    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).select("u", "v").distinct(), "edges")
    seen = digest(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        before, now = now, written(small.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(before)
        last, seen = seen, digest(now)
        if seen == last:
            break
    else:
        raise RuntimeError("components did not settle")
    found = now.groupBy("u").agg(F.min("v").alias("root"))
    roots = found.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return found.select(F.col("u").alias("node"), "root").unionByName(roots)
