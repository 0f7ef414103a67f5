"""Writing tables so that readers see the old or the new state, never a part: replaced partitions,
versioned snapshots, compaction, sorted files. Only names of folders pass through the driver."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smoothway.sources.partitions import DATE, HOUR

TARGET_BYTES = 128 << 20
#: Rows that a task sorts and writes at most, about.
ROWS_PER_TASK = 1_000_000


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at(path))


def replace_partitions(df: DataFrame, path: str, by: tuple[str, ...] = (DATE, HOUR), may_be_empty: bool = True, only: list[dict] | None = None) -> int:
    """Put df's rows in place of its partitions of the table at path; returns the number of rows.

    The rows are staged beside the table, read back and counted; then each old partition is renamed
    to a backup and the staged one takes its place (between the two renames that partition isn't
    there; readers that can't bear it go by write_snapshot's pointer). If that fails half way, the
    backups return. df is computed once: its rows are counted while they are staged. only
    names the partitions that are replaced even where df has no rows for them (an empty one is
    deleted); an empty df that may not be empty is an error.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    stage = f"{path}/_stage-{run}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*by).parquet(stage)
    fs, at = _fs(spark, path)
    schema = df.select(*[c for c in df.columns if c not in by], *by).schema
    staged = spark.read.schema(schema).option("basePath", stage).parquet(stage)
    parts = [r.asDict() for r in staged.groupBy(*by).agg(F.count("*").alias("rows")).collect()]
    rows = sum(p.pop("rows") for p in parts)
    done: list[tuple[str, str]] = []
    try:
        if not rows and not may_be_empty:
            raise ValueError("no rows to write")
        if rows != seen.get["rows"]:
            raise ValueError("the staged rows aren't those that were to be written")
        names = ["/".join(f"{k}={p[k]}" for k in by) for p in parts]
        empty = ["/".join(f"{k}={p[k]}" for k in by) for p in only or []]
        for k, name in enumerate(dict.fromkeys([*names, *empty])):
            backup = f"{path}/_backup-{run}-{k}"
            if fs.exists(at(f"{path}/{name}")):
                fs.rename(at(f"{path}/{name}"), at(backup))
            done.append((name, backup))
            if name in names:
                fs.mkdirs(at(f"{path}/{name}").getParent())
                if not fs.rename(at(f"{stage}/{name}"), at(f"{path}/{name}")):
                    raise OSError(f"{name} couldn't be put in place")
    except BaseException:
        for name, backup in reversed(done):
            fs.delete(at(f"{path}/{name}"), True)
            if fs.exists(at(backup)):
                fs.rename(at(backup), at(f"{path}/{name}"))
        raise
    finally:
        fs.delete(at(stage), True)
    for _, backup in done:
        fs.delete(at(backup), True)
    return rows


def put_text(spark: SparkSession, path: str, text: str) -> None:
    put_bytes(spark, path, text.encode())


def put_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file under another name and rename it over the old one, so readers find one or the other."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, at = _fs(spark, path)
    next_path = at(f"{path}.next-{uuid.uuid4().hex}")
    out = fs.create(next_path, True)
    out.write(bytearray(content))
    out.close()
    ways = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    ways[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    whole = fs.makeQualified(at(path))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), conf).rename(fs.makeQualified(next_path), whole, ways)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    return spark.read.text(path, wholetext=True).first()["value"]


def write_snapshot(df: DataFrame, root: str, **facts) -> str:
    """Write df as a version of its own, read it back, and only then point to it; returns the version.

    df is computed once: its rows are counted while they are written. The pointer is replaced by one rename.
    """
    spark, version, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(f"{root}/version={version}")
    back = spark.read.parquet(f"{root}/version={version}")
    kinds = lambda x: [(f.name, f.dataType) for f in x.schema]
    rows = back.count()
    if kinds(back) != kinds(df) or rows != seen.get["rows"]:
        raise ValueError("the snapshot isn't what was to be written")
    put_text(spark, f"{root}/active.json", json.dumps({"version": version, "rows": rows, **facts}, sort_keys=True))
    return version


def active_manifest(spark: SparkSession, root: str) -> dict:
    """What the pointer says; its rows and version must be there."""
    found = json.loads(read_text(spark, f"{root}/active.json"))
    if not {"version", "rows"} <= set(found):
        raise ValueError("the manifest lacks its version or rows")
    return found


def active_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={active_manifest(spark, root)['version']}")


def file_statistics(table: DataFrame, *by: str) -> DataFrame:
    """Files of each partition: how many, and their total, mean, least and greatest bytes."""
    files = table.select(*by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("at")).distinct()
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.round(F.avg("bytes")).cast("long").alias("mean_bytes"), F.min("bytes").alias("least_bytes"), F.max("bytes").alias("most_bytes"), F.max("at").alias("newest"))


def compact(spark: SparkSession, path: str, by: tuple[str, ...] = (DATE, HOUR), settled: Column | None = None, target_bytes: int = TARGET_BYTES, least_files: int = 2) -> DataFrame:
    """Rewrite partitions of many files into files of about target_bytes; one row a partition looked at.

    A partition is skipped if it has fewer than least_files or isn't settled (a condition on newest,
    the time of its last file). Its rows are dealt to tasks by their file and place, so equal rows don't
    share one and a task that runs again deals alike, and replaced as replace_partitions does, with the count read back.
    """
    # folders' names are kept as text: 00 isn't 0
    kinds = spark.read.parquet(path).drop(*by).schema.fields
    table = spark.read.schema(T.StructType([*kinds, *[T.StructField(k, T.StringType()) for k in by]])).parquet(path)
    told = file_statistics(table, *by).withColumn("why", F.when(F.col("files") < least_files, "few files").when(~settled if settled is not None else F.lit(False), "too recent"))
    found = [r.asDict() for r in told.collect()]
    chosen = [r for r in found if r["why"] is None and r["files"] > -(-r["bytes"] // target_bytes)]
    if chosen:
        pieces = spark.createDataFrame([(*[str(r[k]) for k in by], -(-r["bytes"] // target_bytes)) for r in chosen], ", ".join([f"{k} string" for k in by] + ["_pieces long"]))
        names = pieces.select(*[F.col(k).alias(f"_{k}") for k in by], "_pieces")
        on = [F.col(k).cast("string") == F.col(f"_{k}") for k in by]
        placed = table.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place"))
        rows = placed.join(F.broadcast(names), on).withColumn("_piece", F.pmod("_place", "_pieces"))
        replace_partitions(rows.repartition(*by, "_piece").select(*table.columns), path, by)
    done = {tuple(r[k] for k in by) for r in chosen}
    return spark.createDataFrame([(*[str(r[k]) for k in by], r["files"], tuple(r[k] for k in by) in done, r["why"]) for r in found], ", ".join([f"{k} string" for k in by] + ["files long", "compacted boolean", "why string"]))


def write_sorted(df: DataFrame, path: str, order: list[str], rows_per_file: int = 100_000) -> None:
    """Files of about rows_per_file rows in an order over all of them, ZSTD: least and greatest values of a
    file then tell whether a reader needs it."""
    files = max(1, -(-df.count() // rows_per_file))
    # a task writes several files one after another: each task reports to the driver, each file doesn't
    tasks = min(files, max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-files * rows_per_file // ROWS_PER_TASK)))
    kept = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    kept.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
