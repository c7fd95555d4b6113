"""MinHash near-duplicate documents: banding, signature check, exact check, components.

Every document is its set of distinct shingles of a few words.  Documents with the
same set are one class; the classes are sketched with ``BANDS * ROWS``
universal hash minima.  A class meets the smallest class of each band bucket
first; what is still in another component after that meets every member of
its buckets.  A pair must pass a signature estimate (2 bits of each minimum)
and then the exact test on the full sets.  Components come from alternating
large-star and small-star (``components``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import MIX_1, mix, text_slices, word_hashes, word_spans
from .names import renamed_keys, with_node
from .rounds import joined_up, shared_buckets
from .scratch import drop_stored, sieved, stored, stored_by

#: A pair of Jaccard 0.8 shares no bucket with probability (1 - 0.8**5)**40, about 1e-7.
BANDS, ROWS = 40, 5
THRESHOLD_PERCENT = 80
#: The signature estimate must reach the threshold less 4.5 standard deviations.
MARGIN = 0.15
_WORDS = 7


def _perms() -> np.ndarray:
    """Odd multipliers of the universal hashes."""
    n = BANDS * ROWS
    return (mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(MIX_1)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(buf: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``width`` words (fewer words: all of them as one)."""
    starts, ends, first = word_spans(buf, bounds)
    h = word_hashes(buf, starts, ends)
    runs = [h]  # runs[k] has the hashes of k + 1 words
    for k in range(1, width):
        runs.append(mix(runs[-1][:-1] * np.uint64(3) + mix(h[k:])))
    for lo, hi in zip(first[:-1], first[1:]):
        n = min(width, hi - lo)
        yield np.unique(runs[n - 1][lo:hi - n + 1]) if n else h[:0]


def _minima(shingles: np.ndarray, perms: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(perms), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 256):
        np.minimum(out, (low[i:i + 256, None] * perms).min(axis=0), out=out)
    return out


def _prints(shingles: np.ndarray) -> tuple:
    """Two sums that name a set."""
    if not len(shingles):
        return 0, 0
    m = mix(shingles)
    return np.add.reduce(m).view(np.int64), np.add.reduce(mix(m ^ np.uint64(MIX_1))).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    perms = _perms()
    weights = mix(np.arange(1, ROWS + 1, dtype=np.uint64))
    tags = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(MIX_1)
    for batch in batches:
        sizes, prints, bands, bits = [], [], [], []
        for _, buf, bounds in text_slices(batch.column(1)):
            for s in shingle_sets(buf, bounds, width):
                sizes.append(len(s))
                prints.append(_prints(s))
                if len(s):
                    minima = _minima(s, perms)
                    rows = minima.astype(np.uint64).reshape(BANDS, ROWS)
                    bands.append(mix((rows * weights).sum(axis=1, dtype=np.uint64) + tags).view(np.int64))
                    two = np.zeros(_WORDS * 32, np.uint64)
                    two[:len(minima)] = mix(minima.astype(np.uint64)) & np.uint64(3)
                    shifted = two.reshape(_WORDS, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
                    bits.append(np.bitwise_or.reduce(shifted, axis=1).view(np.int64))
                else:
                    bands.append(np.zeros(0, np.int64))
                    bits.append(np.zeros(_WORDS, np.int64))
        p = np.array(prints, np.int64).reshape(-1, 2)
        b = np.array(bits, np.int64).reshape(-1, _WORDS)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(p[:, 0]), pa.array(p[:, 1]),
             pa.ListArray.from_arrays(ends, pa.array(flat))] + [pa.array(b[:, i]) for i in range(_WORDS)],
            names=["id", "n", "p1", "p2", "bands"] + [f"s{i}" for i in range(_WORDS)])


def _alike(x: str, y: str) -> Column:
    """The estimate from two bits of each minimum reaches threshold - MARGIN."""
    odd = F.lit(0x5555555555555555)
    differ = None
    for i in range(_WORDS):
        d = F.col(f"{x}.s{i}").bitwiseXOR(F.col(f"{y}.s{i}"))
        one = F.bit_count((d.bitwiseOR(F.shiftright(d, 1))).bitwiseAND(odd))
        differ = one if differ is None else differ + one
    k = BANDS * ROWS
    agree = 0.25 + 0.75 * (THRESHOLD_PERCENT / 100 - MARGIN)
    return differ <= int(k * (1 - agree))


def _differ_columns() -> list[str]:
    return [f"s{i}" for i in range(_WORDS)]


def _sets_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s for _, buf, bounds in text_slices(batch.column(1)) for s in shingle_sets(buf, bounds, width)]
        p = np.array([_prints(s) for s in sets], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(s) for s in sets], pa.int64()), pa.array(p[:, 0]), pa.array(p[:, 1]),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["n", "p1", "p2", "shingles"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shingle of the sets of (node, cluster, shingles), a few thousand shingles at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(2)]
            row = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(row), part.column(1).take(row), pa.array(np.concatenate(sets))],
                names=["node", "cluster", "shingle"])


def _jaccard(percent: int) -> Callable:
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int(np.count_nonzero(q[at] == p))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return linked


def _name(salt: int = 0) -> Column:
    """A set's node: 64 bits of its size and its two sums."""
    return F.xxhash64("n", "p1", "p2", F.lit(salt)) if salt else F.xxhash64("n", "p1", "p2")


def _with_node(sets: DataFrame, renamed: DataFrame | None) -> DataFrame:
    """``sets(n, p1, p2, ..)`` with its node; sets are told apart as far as 128 bits do that."""
    return with_node(sets, ["n", "p1", "p2"], _name, renamed)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; ``width`` of them
    make a shingle: two by the contract of op4, five in a pipeline's stage.  A
    text with fewer has all its words as its only shingle; null, empty and blank texts have
    an empty set, are linked with nothing and are their own component.  Rows
    with the same id count as one node (each row keeps its own n_shingles); a
    row with a null id is linked with nothing, has a null component and is
    kept.  Other columns are ignored, whatever their names.  An empty table
    gives an empty result.

    No bucket is cut: exact copies are folded before banding, a bucket's rows
    meet its smallest member through a join that AQE can split, and only
    members that are still in different components meet each other.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    fields = [T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("p1", T.LongType()),
              T.StructField("p2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    fields += [T.StructField(c, T.LongType()) for c in _differ_columns()]
    sketches = stored(rows.mapInArrow(partial(_sketches, width=width), T.StructType(fields)), "sketches")

    named = sketches.where("n > 0 and id is not null")
    classes = stored(named.groupBy("n", "p1", "p2").agg(
        F.min("id").alias("id"), F.first("bands").alias("bands"), *[F.first(c).alias(c) for c in _differ_columns()])
        .select("id", "n", "p1", "p2", "bands", *_differ_columns()), "classes")
    renamed, found = renamed_keys(classes, ["n", "p1", "p2"], _name), classes
    classes = _with_node(classes, renamed).select("id", "node", "bands", *_differ_columns())
    # from here on a row is its id and the name of its set
    rows_of = stored(sketches.select("id", "n", "p1", "p2"), "rows")
    drop_stored(sketches)
    named = rows_of.where("n > 0 and id is not null")
    nodes = classes.select("node", *_differ_columns())
    members = classes.select("node", F.explode("bands").alias("key"))
    shared = stored(shared_buckets(members), "shared")

    # the classes of an id with several texts belong together
    held = _with_node(named, renamed).select("id", "node")
    several = held.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a <> last").select("id", "a")
    same = stored(held.join(several, "id").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "same")

    wanted = stored(shared.select("node").distinct().join(classes.select("id", "node"), "node"), "wanted")
    # a row's set goes by its own text; an id of wanted may have other texts besides the class's
    needed = wanted.select("id").distinct()
    picked = sieved(rows, needed, "id").join(needed, "id", "left_semi").mapInArrow(
        partial(_sets_of, width=width), T.StructType([
            *[T.StructField(c, T.LongType()) for c in ("n", "p1", "p2")], T.StructField("shingles", T.BinaryType())]))
    # in buckets by node: every comparison joins the sets, and moves only its pairs
    sets = stored_by(_with_node(picked, renamed).select("node", "shingles").join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets", "node")

    pair_type = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        return (pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
                .mapInArrow(_jaccard(THRESHOLD_PERCENT), pair_type))

    def listed(clusters: DataFrame) -> DataFrame:
        held = clusters.join(sets, "node").select("node", "cluster", "shingles")
        return held.mapInArrow(_listed, T.StructType([
            T.StructField("node", T.LongType()), T.StructField("cluster", T.LongType()), T.StructField("shingle", T.LongType())]))

    sizes = sets.select("node", (F.length("shingles") / 8).cast("long").alias("n"))
    labels = joined_up(shared, verified, THRESHOLD_PERCENT, nodes, _alike, sizes, listed, given=same)
    # a component's name is its smallest id; a row without words goes with the other rows of its id
    placed = held.join(labels, "node", "left").select("id", F.coalesce("component", "node").alias("root")).distinct()
    placed = stored(placed, "placed")
    for table in (found, shared, same, wanted, labels):
        drop_stored(table)
    names = placed.groupBy("root").agg(F.min("id").alias("component"))
    folded = placed.join(names, "root").select("id", "component")
    out = rows_of.select("id", "n").join(folded, "id", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
