"""Importance resampling towards a target: hashed n-grams from running CRCs, one scan a document.

A document is normalised to its words with one space before each.  The CRC
after every word is kept; that after a space is one table step further.  With
them the CRC of any run of words follows without reading it again:
``crc(b) = crc(ab) ^ shift(crc(a), len(b))``, where the shift by zero bytes is a
linear map over GF(2) that cancels what comes before the run.

Counts of the hashed n-grams over all documents and over all target texts give
each bucket a gain; a document's weight is the sum over its n-grams.  A
Gumbel number from the id is added and the highest scores are drawn.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import text_slices, word_spans
from .scratch import stored

BUCKETS, WIDTH = 10_000, 3
MIN_WORDS, DRAWN_PERCENT, SEED = 20, 5, 42
#: The reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320

#: Bytes between words: all of ASCII but digits and letters.
_between = np.zeros(256, bool)
_between[:128] = [not chr(b).isalnum() for b in range(128)]
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _byte_steps() -> np.ndarray:
    """What each value of the register's low byte adds as it is shifted out."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), c >> np.uint32(1))
    return c


class Shifts:
    """The linear maps that append zero bytes to a CRC, as tables of four bytes by 256 values."""

    SHORT = 256

    def __init__(self) -> None:
        self.steps = _byte_steps()
        values = np.arange(256, dtype=np.uint32)
        table = np.stack([values << np.uint32(8 * j) for j in range(4)])
        short = []
        for _ in range(self.SHORT):
            short.append(table)
            table = self.steps[table & np.uint32(255)] ^ (table >> np.uint32(8))
        self.short = np.stack(short)
        self.long = [table]  # SHORT zero bytes, then twice as many each time
        while len(self.long) < 40:
            self.long.append(self._by(self.long[-1], self.long[-1]))

    @staticmethod
    def _by(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = table[0][crc & np.uint32(255)]
        for j in range(1, 4):
            out = out ^ table[j][(crc >> np.uint32(8 * j)) & np.uint32(255)]
        return out

    def apply(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Each CRC with n zero bytes appended."""
        base = (n & (self.SHORT - 1)) << 10
        flat = self.short.ravel()
        out = flat[base + (crc & np.uint32(255))]
        for j in range(1, 4):
            out ^= flat[base + 256 * j + ((crc >> np.uint32(8 * j)) & np.uint32(255))]
        rest = n // self.SHORT
        for table in self.long:
            if not rest.any():
                break
            odd = np.flatnonzero(rest & 1)
            out[odd] = self._by(table, out[odd])
            rest = rest >> 1
        return out

    def space(self, crc: np.ndarray) -> np.ndarray:
        """Each CRC with one space appended."""
        c = ~crc
        return ~(self.steps[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8)))


def ngram_crcs(buf: np.ndarray, bounds: np.ndarray, shifts: Shifts, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(first, crcs): crcs[n - 1][k] is the CRC of the n words from word k on; first has each text's first word.

    Runs over the end of a text are among them; ``of_text`` leaves them out.
    """
    starts, ends, first = word_spans(buf, bounds, _between)
    if not len(starts):
        return first, [np.zeros(0, np.uint32)] * width
    inside = ~_between[buf]
    at = np.flatnonzero(inside)
    number = np.zeros(len(buf), np.int64)
    number[starts] = 1
    plain = np.full(len(at) + len(starts), 32, np.uint8)
    plain[np.arange(len(at)) + np.cumsum(number[at])] = _lower[buf[at]]
    crc, words = 0, re.findall(rb" [^ ]+", plain.tobytes())
    after = np.array([crc := zlib.crc32(w, crc) for w in words], np.uint32)
    before = shifts.space(np.concatenate([np.zeros(1, np.uint32), after[:-1]]))
    stop = np.cumsum(ends - starts + 1)
    start = stop - (ends - starts)
    out = []
    for n in range(1, width + 1):
        out.append(after[n - 1:] ^ shifts.apply(before[:len(before) - n + 1], stop[n - 1:] - start[:len(start) - n + 1]))
    return first, out


def of_text(first: np.ndarray, crcs: list[np.ndarray], i: int) -> np.ndarray:
    """The CRCs of all runs of words within text i."""
    lo, hi = first[i], first[i + 1]
    return np.concatenate([c[lo:max(lo, hi - n)] for n, c in enumerate(crcs)])


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _features(batches: Iterator[pa.RecordBatch], buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    shifts, kind = Shifts(), _kind(buckets)
    for batch in batches:
        words, found = [], []
        for _, buf, bounds in text_slices(batch.column(1)):
            first, crcs = ngram_crcs(buf, bounds, shifts, width)
            hashed = [(c % np.uint32(buckets)).astype(kind) for c in crcs]
            words += np.diff(first).tolist()
            found += [of_text(first, hashed, i).tobytes() for i in range(len(bounds) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(found, pa.binary())],
                                         names=["id", "n_words", "features"])


def features(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, width: int = WIDTH) -> DataFrame:
    """``(id, n_words, features)``: the buckets of all runs of 1 to ``width`` words, as packed 16-bit values (32 for over 65,536 buckets)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(partial(_features, buckets=buckets, width=width), T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("features", T.BinaryType())]))


def _counted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """A task's sums: one row a bucket."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for x in batch.column(0):
            total += np.bincount(np.frombuffer(x.as_buffer(), _kind(buckets)), minlength=buckets)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], names=["bucket", "n"])


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` over all rows of ``features``, one row a bucket."""
    parts = found.select("features").mapInArrow(partial(_counted, buckets=buckets), "bucket long, n long")
    every = found.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("n"))
    return parts.unionByName(every).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` from two tables of ``features``: the smoothed log ratio, target over documents, in thousandths."""
    s = bucket_counts(docs, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, buckets).withColumnRenamed("n", "t")
    both = stored(s.join(t, "bucket"), "counts")
    total = lambda c: both.agg((F.sum(c) + buckets).cast("double")).scalar()
    ratio = (F.col("t") + 1).cast("double") * total("s") / ((F.col("s") + 1).cast("double") * total("t"))
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain"))


def _weighed(gains, buckets: int) -> Callable:
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), _kind(buckets)) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in rows], pa.int64()),
                 pa.array([int(gain[x].sum()) for x in rows], pa.int64())], names=["id", "n_words", "n_features", "weight"])
    return weighed


def _gumbel(id_col: str, seed: int) -> Column:
    """floor(1000 * Gumbel number) from the id; a null id as the text 'null'."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``(id_col, n_features, weight, score, rank)`` for every row of ``docs``; rows with a rank are drawn.

    Words are runs of digits, letters and bytes outside ASCII, A-Z in lower
    case; features are runs of 1 to WIDTH words joined by one space, hashed by
    CRC-32 modulo ``buckets``.  Of the rows with ``min_words`` words or more,
    the ``percent`` with the highest scores are drawn, ranked from 1 on, equal
    scores by id.  Null and empty texts have no features and weight 0; a null
    id has the score of the text 'null' and comes last among equal scores.
    Rows that repeat an id count and are drawn each by itself.  Other columns
    are ignored.  Without target texts all gains follow from smoothing alone;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    found = stored(features(docs, id_col, text_col, buckets), "features", "zstd")
    aims = stored(features(target.select(F.lit(0).alias("no"), target_text_col), "no", target_text_col, buckets), "aims", "zstd")
    gains = np.zeros(buckets, np.int64)  # one number a bucket, whatever the tables' size
    for row in bucket_gains(found, aims, buckets).collect():
        gains[row.bucket] = row.gain
    weighed = found.mapInArrow(_weighed(spark.sparkContext.broadcast(gains), buckets), T.StructType([
        found.schema["id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]]))
    scored = weighed.withColumn("score", F.col("weight") + _gumbel("id", seed))

    # range partitions in the order of the ranks; written with their place there, so that no later plan depends on the partitioning
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    scored = stored(scored, "scored")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = scored.where(F.col("n_words") >= min_words).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("place", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("place", 33)
    sizes = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    drawn = ranged.agg(F.floor(F.lit(percent) * F.count("*") / 100)).scalar()
    rank = F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = ranged.withColumn("part", part).join(offsets, "part").withColumn("rank", rank)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    return ranked.select(*columns).unionByName(others.select(*columns))
