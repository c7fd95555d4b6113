"""Tables written to the shared folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeflens.session import ensure_checkpoint_dir


#: Bits of a sieve, two megabytes; for many keys up to SIEVE_MOST, eight megabytes, so that it has SIEVE_SHARE bits a key.
SIEVE_BITS, SIEVE_MOST, SIEVE_SHARE = 1 << 24, 1 << 26, 16
#: Spark removes a query's shuffle files when it has ended; otherwise they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one table under ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/reeflens-llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; the session's own setting comes back."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, column: str, codec: str = "snappy") -> DataFrame:
    """``stored`` in as many buckets by ``column`` as shuffles have partitions: grouping by it needs no exchange.

    The table's name lives only until its plan is made; the files stay, as those of ``stored``.
    """
    spark = df.sparkSession
    table = f"reeflens_{name}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).format("parquet")
    with _shuffles_removed(spark):
        writer.option("path", new_path(spark, name)).option("compression", codec).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved: the plan has the files and the buckets
    spark.sql(f"DROP TABLE {table}")
    return out


def sieved(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be in ``keys``, so that a semi join on it moves few others.

    A bitmap of SIEVE_BITS hashed keys, or more where that is few for them, is
    sent to the scan.  No row of ``keys`` is lost; of the others a share of about
    keys / bits stays, all of them where keys are far more than SIEVE_MOST.
    """
    bits, wanted = SIEVE_BITS, SIEVE_SHARE * keys.count()
    while bits < min(wanted, SIEVE_MOST):
        bits *= 2
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place).cast("int")
    maps = keys.where(F.col(column).isNotNull()).groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    rows = df.select(F.struct(*df.columns).alias("_row"), bucket.alias("_bucket"), bit.alias("_bit")).join(F.broadcast(maps), "_bucket")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.expr("_bit div 8 + 1").cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(_byte, _bit % 8) & 1") == 1
    return rows.withColumn("_byte", byte).where(held).select("_row.*")


def drop_stored(df: DataFrame) -> None:
    """Delete a table of ``stored`` that no later plan reads."""
    spark = df.sparkSession
    for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
