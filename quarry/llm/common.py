"""Shared helpers: tables, the scratch store, and Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one Arrow batch holds at most, so that Python workers need bounded memory.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_base(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``). Where that is unset: a temporary folder in local mode;
    on a cluster there is no folder that surely all machines share, so it must be set there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if spark.conf.get("spark.master", "").startswith("local") and "cluster" not in spark.conf.get("spark.master", ""):
        base = "file://" + tempfile.mkdtemp(prefix="quarry-")
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    spark.conf.set("spark.quarry.scratch", base)
    return base


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the scratch store and reads it again: lineage is cut, lost executors cost nothing
    that was written, and task numbers and row order of the written rows can no longer change. The files go when
    the session's JVM ends."""
    spark = df.sparkSession
    base = spark.conf.get("spark.quarry.scratch", None) or scratch_base(spark)
    path = f"{base.rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a filter of keys at most: 64 MB.
FILTER_BITS = 1 << 29


def split_by_keys(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may stand in keys, rows whose key surely doesn't), so that the latter need no shuffle. keys: one column of longs, staged. A bit for
    each key is set in a bitmap of at most FILTER_BITS, which is sent to all tasks; beyond that many keys more rows may."""
    bits = min(FILTER_BITS, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(bits))
    at = place(F.col(keys.columns[0]))
    bitmap = keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bitmap"))
    bitmap = F.broadcast(stage(bitmap, "filter"))
    bit = F.bitmap_bit_position(place(key)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.shiftright(bit, 3) + F.lit(1), F.lit(1))), 16, 10).cast("int")
    found = rows.join(bitmap, F.bitmap_bucket_number(place(key)) == F.col("_bucket"), "left")
    hit = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return found.where(hit).drop("_bucket", "_bitmap"), found.where(~hit).drop("_bucket", "_bitmap")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches for Python are bounded in bytes as well as in rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release_memory() -> None:
    """Gives a worker's free memory back. An executor keeps more idle Python workers than it has cores and takes them in turn, so
    what each of them holds on to after a task adds up."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """mapInArrow with batches of bounded size; the worker's memory is released after each task."""

    def run(batches: Iterator) -> Iterator:
        yield from fn(batches)
        release_memory()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def doc_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone; extra columns, whatever their names, don't matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def crc32_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
