"""Removal of repeated byte passages by hashed names of the strings at triggers.

The phrases are cut as in prefix-free parsing, but its dictionary and suffix
arrays are replaced by names: nothing is ranked or put in corpus order.

1. A rolling hash over WINDOW bytes places triggers, which cut every text into
   phrases; where MATCH bytes hold no trigger, their window of least hash takes
   its place.  A start position's suffix is the rest of its phrase (a suffix of
   a dictionary phrase, up to the next trigger) followed by a suffix of the
   parse.
2. Positions of one phrase are handled together.  A MATCH-byte string that
   begins d bytes before its trigger holds the KEY bytes around the trigger,
   which only d's block of BLOCK bytes decides; positions whose key is found
   once in the corpus are not repeated.
3. Only whether a position has another with the same MATCH bytes is asked for,
   not which of two suffixes comes first: equal strings get equal 128-bit
   names (two independent hashes).  Whole runs of positions are named first,
   which settles long matches; positions of runs that are found once are
   named one by one, against those of the other runs of their key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import BASE, MIX_1, mix, powers, text_slices
from .scratch import stored

MATCH = 400
WINDOW = 16
#: A position is a trigger with probability 1 / 2**PHRASE_BITS.
PHRASE_BITS = 6
BLOCK = 128
KEY = MATCH - BLOCK + 1
#: Positions that are hashed at once.
CORE = 1 << 20
#: The base of the second hash; odd, as BASE.
BASE_2 = 0xD6E8FEB86659FD93

_value = np.arange(1, 257, dtype=np.uint64)


def _sums(x: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(x) + 1, base)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[:len(x)], out=total[1:])
    return total, down


def _hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end, wherever they stand."""
    return (sums[0][end] - sums[0][start]) * sums[1][start]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value in every stretch of ``width``, by minima of blocks from both sides."""
    low = np.uint64((1 << 22) - 1)
    x = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    n = len(x) - width + 1
    x = np.append(x, np.full(-len(x) % width, ~np.uint64(0)))
    ahead = np.minimum.accumulate(x.reshape(-1, width), axis=1).ravel()
    back = np.minimum.accumulate(x.reshape(-1, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1:width - 1 + n]) & low).astype(np.int64)


def _runs(buf: np.ndarray, lo: int, hi: int, end_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of start positions in [lo, hi): first, length - 1, key and name of each run.

    ``end_of`` has the end of the text for each position of the range.
    """
    x = _value[buf[lo:min(len(buf), hi + MATCH)]]
    one, two = _sums(x, BASE), _sums(x, BASE_2)
    at = np.arange(max(0, len(x) - WINDOW + 1))
    rolled = mix(_hash(one, at, at + WINDOW))
    trigger = np.flatnonzero((rolled >> np.uint64(64 - PHRASE_BITS)) == 0)
    v = np.flatnonzero(np.arange(lo, hi) + MATCH <= end_of)
    t = np.append(trigger, 1 << 40)[np.searchsorted(trigger, v)]
    alone = t - v > MATCH - WINDOW
    edges = np.flatnonzero(np.diff(np.concatenate([[False], alone, [False]])))
    for i, j in zip(edges[::2], edges[1::2]):  # no trigger inside the string: its least window takes the place
        for k in np.split(np.arange(i, j), np.flatnonzero(np.diff(v[i:j]) > 1) + 1):
            t[k] = v[k[0]] + _least(rolled[v[k[0]]:v[k[-1]] + MATCH - WINDOW + 1], MATCH - WINDOW + 1)
    block = (t - v) // BLOCK + np.where(alone, 8, 0)
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1] + 1) | (t[1:] != t[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    a, b = v[first], v[np.append(first[1:], len(v)) - 1] if len(v) else v
    key_at = t[first] - BLOCK * (block[first] % 8)
    key = mix(_hash(one, key_at, key_at + KEY) + block[first].astype(np.uint64) * np.uint64(MIX_1))
    name = mix(_hash(two, a, b + MATCH) + (b - a).astype(np.uint64))
    return a + lo, b - a, key.view(np.int64), name.view(np.int64)


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, buf, bounds in text_slices(batch.column(1)):
            for lo in range(0, len(buf), CORE):
                hi = min(len(buf), lo + CORE)
                text = np.searchsorted(bounds, np.arange(lo, hi), "right") - 1
                a, extra, key, name = _runs(buf, lo, hi, bounds[text + 1])
                of = text[a - lo]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + of)), pa.array(a - bounds[of]), pa.array(extra.astype(np.int32)),
                     pa.array(key), pa.array(name)], names=["row", "a", "extra", "key", "name"])


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every position of the listed runs of a text with the name of its MATCH bytes."""
    for batch in batches:
        for k in range(batch.num_rows):
            buf = np.frombuffer(batch.column(1)[k].as_buffer(), np.uint8)
            a, extra, key = (batch.column(c)[k].values.to_numpy().astype(np.int64) for c in (2, 3, 4))
            lone = np.asarray(batch.column(5)[k].values.to_pylist(), bool)
            order = np.argsort(a, kind="stable")
            for lo in range(0, len(buf), CORE):
                pick = order[np.searchsorted(a[order], lo):np.searchsorted(a[order], lo + CORE)]
                if not len(pick):
                    continue
                sums = _sums(_value[buf[lo:lo + CORE + 3 * MATCH]], BASE_2)
                run = np.repeat(pick, extra[pick] + 1)
                step = np.arange(len(run)) - np.repeat(np.cumsum(extra[pick] + 1) - extra[pick] - 1, extra[pick] + 1)
                at = a[run] + step - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(run), batch.column(0)[k].as_py(), np.int64)), pa.array(at + lo), pa.array(key[run]),
                     pa.array(mix(_hash(sums, at, at + MATCH)).view(np.int64)), pa.array(lone[run])],
                    names=["row", "at", "key", "name", "lone"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged spans of a text and what is left of it."""
    for batch in batches:
        spans, texts = [], []
        for k in range(batch.num_rows):
            data = batch.column(1)[k].as_buffer().to_pybytes()
            s, e = (batch.column(c)[k].values.to_numpy().astype(np.int64) for c in (2, 3))
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            first = np.append(True, s[1:] > e[:-1])
            s, e = s[first], e[np.append(np.flatnonzero(first)[1:], len(e)) - 1]
            ends = np.append(0, e)
            texts.append(b"".join(data[i:j] for i, j in zip(ends, np.append(s, len(data)))))
            spans.append([{"start": int(i), "end": int(j)} for i, j in zip(s, e)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(texts, pa.binary())], names=["row", "spans", "kept"])


def _row(id_col: Column, text: Column) -> Column:
    """What tells one row from another; equal rows are equal texts and may share it."""
    return F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("\0")), text)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, spans, kept)`` for the texts that have a repeated passage.

    ``row`` is ``_row`` of id and text, ``spans`` the maximal byte ranges that
    MATCH-byte strings found at another place cover, ``kept`` the other bytes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(_row(F.col(id_col), text).alias("row"), text.alias("text"))
    runs = texts.mapInArrow(_phrases, T.StructType([
        T.StructField("row", T.LongType()), T.StructField("a", T.LongType()), T.StructField("extra", T.IntegerType()),
        T.StructField("key", T.LongType()), T.StructField("name", T.LongType())]))
    often = runs.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    runs = stored(runs.join(often, "key"), "runs")

    named = stored(runs.groupBy("key", "name", "extra").agg(
        F.count("*").alias("c"), F.min(F.struct("row", "a")).alias("one")), "names")
    covered = runs.join(named.where("c > 1").select("key", "name", "extra"), ["key", "name", "extra"]).select(
        "row", F.col("a").alias("start"), (F.col("a") + F.col("extra") + MATCH).alias("end"))
    mixed = named.groupBy("key").agg(F.count("*").alias("names"), F.min("c").alias("least")).where("names > 1 and least = 1")
    open_runs = named.join(mixed.select("key"), "key").select(
        F.col("one.row").alias("row"), F.col("one.a").alias("a"), "extra", "key", (F.col("c") == 1).alias("lone"))

    with_runs = runs.select("row").distinct()
    held = stored(texts.join(with_runs, "row", "left_semi").groupBy("row").agg(F.first("text").alias("text")), "texts")
    listed = open_runs.groupBy("row").agg(F.collect_list(F.struct("a", "extra", "key", "lone")).alias("r"))
    positions = held.join(listed, "row").select("row", "text", "r.a", "r.extra", "r.key", "r.lone").mapInArrow(
        _positions, T.StructType([T.StructField("row", T.LongType()), T.StructField("at", T.LongType()),
                                  T.StructField("key", T.LongType()), T.StructField("name", T.LongType()),
                                  T.StructField("lone", T.BooleanType())]))
    positions = stored(positions, "positions")
    twice = positions.groupBy("key", "name").agg(F.count("*").alias("c")).where("c > 1").select("key", "name")
    single = positions.where("lone").join(twice, ["key", "name"]).select(
        "row", F.col("at").alias("start"), (F.col("at") + MATCH).alias("end"))

    spans = covered.unionByName(single).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("s"))
    out = T.StructType([T.StructField("row", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.BinaryType())])
    return held.join(spans, "row").select("row", "text", "s.start", "s.end").mapInArrow(_cut, out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``.

    A byte goes if a string of MATCH bytes that covers it also begins anywhere
    else, in another row or in the same text; overlaps count and nothing
    crosses a text's ends.  Equal rows repeat each other.  A null text is
    empty; texts under MATCH bytes keep all.  Null ids keep their rows.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    whole = docs.select(F.col(id_col).alias("id"), _row(F.col(id_col), text).alias("row"),
                        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    cut = repeated_spans(docs, id_col, text_col).select(
        "row", F.sha2("kept", 256).alias("cut_sha"), F.octet_length("kept").cast("long").alias("kept_bytes"),
        F.size("spans").cast("long").alias("spans"))
    zero = F.lit(0).cast("long")
    return whole.join(cut, "row", "left").select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce(F.col("n_bytes") - F.col("kept_bytes"), zero).alias("n_removed"),
        F.coalesce("spans", zero).alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"))
