"""Shared helpers: work tables in the shared folder, and session limits."""

from __future__ import annotations

import atexit
import gc
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handed to a Python worker at once.
ARROW_BATCH_BYTES = 4 << 20

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset, in local mode as in tests, a folder below the warehouse is used; a
    cluster must name one, since its warehouse may be a folder of the driver's machine.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/helixframe/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it again."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._helix_path = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that have ended, on all executors.

    Spark does so when the driver collects its garbage, which a small driver load may put off for long.
    """
    gc.collect()
    spark._jvm.System.gc()


def drop(df: DataFrame) -> None:
    """Delete what ``saved`` wrote, once nothing reads it any more."""
    if path := getattr(df, "_helix_path", None):
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm, jsc = spark._jvm, spark._jsc
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)
    _made[:] = [x for x in _made if x[1] != path]


@atexit.register
def _clean() -> None:
    for spark, path in list(_made):
        try:
            remove(spark, path)
        except Exception:  # the session may be gone; the folder is the cluster's scratch space
            break


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows, so long texts can't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bits of the map that says which rows may be among some keys: 16 MB at most, however many keys there are.
MAP_BITS = 1 << 27


def _equal(docs: DataFrame, keys: list[str], other: DataFrame):
    return reduce(lambda a, b: a & b, [docs[k].eqNullSafe(other[f"__helix_by_{k}"]) for k in keys])


def split_by(docs: DataFrame, found: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``docs`` whose ``keys`` aren't in ``found``, rows whose keys may be, and ``found`` to join the latter with.

    A bit map of the keys' hashes, of fixed size, tells them apart, so only the latter need move.
    With more keys than it has bits all may be among them, and all move.
    """
    f = found.select(*(F.col(k).alias(f"__helix_by_{k}") for k in keys)).distinct()
    bit = lambda names: F.pmod(F.xxhash64(*names), F.lit(MAP_BITS)) + 1
    maps = (
        f.select(bit([f"__helix_by_{k}" for k in keys]).alias("b"))
        .groupBy(F.bitmap_bucket_number("b").alias("__helix_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("__helix_map"))
    )
    place = F.bitmap_bit_position(bit(keys))
    byte = F.conv(F.hex(F.substr("__helix_map", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(__helix_byte, cast(__helix_place % 8 as int)) & 1") == 1, F.lit(False))
    told = (
        docs.withColumn("__helix_bucket", F.bitmap_bucket_number(bit(keys))).join(F.broadcast(maps), "__helix_bucket", "left")
        .withColumns({"__helix_byte": byte, "__helix_place": place}).withColumn("__helix_hit", hit)
    )
    return (
        told.where("not __helix_hit").select(*docs.columns),
        told.where("__helix_hit").select(*docs.columns),
        f,
    )


def without(docs: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` aren't in ``dropped``; nulls are equal to each other. Few others move."""
    others, perhaps, d = split_by(docs, dropped, keys)
    return others.unionByName(perhaps.join(d, _equal(perhaps, keys, d), "left_anti"))


def one_each(docs: DataFrame, repeated: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` with one row for each value of ``keys`` in ``repeated``; few others move."""
    if not repeated.limit(1).count():
        return docs
    others, perhaps, r = split_by(docs, repeated, keys)
    same = perhaps.join(r, _equal(perhaps, keys, r), "left_semi").dropDuplicates(keys)
    return others.unionByName(perhaps.join(r, _equal(perhaps, keys, r), "left_anti")).unionByName(same)
