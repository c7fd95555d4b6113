"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is fitted in numpy
on confirmed toxic texts and on unlabelled ones with the non-negative risk
estimator: the risk of unlabelled texts as negatives is corrected by the class
prior times the risk of toxic texts as negatives, and where a batch makes the
corrected part negative, the step goes the other way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import MIX_1, mix, text_slices, word_hashes, word_spans
from .linear import Rows, adam, sigmoid

DIM_BITS = 17
PREFIXES = (3, 4, 5, 6)
#: Bounds of the samples that are fitted.
MAX_POSITIVE, MAX_UNLABELLED = 2000, 6000
#: Features that are fitted: those that toxic texts have most surely more often than others.
FEATURES = 128
STEPS, RATE, DECAY, BATCHES = 400, 0.1, 1e-4, 4
#: Documents with this remainder of crc32(id) mod 5 are held out.
FOLDS, HELD = 5, 0

_fold = np.arange(256, dtype=np.uint64)
_fold[65:91] += np.uint64(32)


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def _features(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (one row per word: the word and its beginnings), and each text's first word."""
    starts, ends, first = word_spans(buf, bounds)
    out = np.empty((len(starts), 1 + len(PREFIXES)), np.int64)
    shift = np.uint64(64 - DIM_BITS)
    out[:, 0] = (word_hashes(buf, starts, ends) >> shift).astype(np.int64)
    begin, k = np.zeros(len(starts), np.uint64), 1
    for j in range(max(PREFIXES)):
        at = np.minimum(starts + j, len(buf) - 1)
        begin = begin * np.uint64(257) + np.where(starts + j < ends, _fold[buf[at]] if len(buf) else 0, 0).astype(np.uint64)
        if j + 1 in PREFIXES:
            out[:, k] = (mix(begin + np.uint64((j + 2) * MIX_1 % (1 << 64))) >> shift).astype(np.int64)
            k += 1
    return out, first


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(positive, index, count): the feature counts of sampled texts over their number of words."""
    for batch in batches:
        index, value = [], []
        for _, buf, bounds in text_slices(batch.column(1)):
            found, first = _features(buf, bounds)
            for lo, hi in zip(first[:-1], first[1:]):
                i, c = np.unique(found[lo:hi], return_counts=True)
                index.append(i.astype("<i4").tobytes())
                value.append((c / (hi - lo + 3)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.binary()), pa.array(value, pa.binary())],
                                         names=["positive", "index", "value"])


def _strength(share: np.ndarray) -> np.ndarray:
    """A feature's value: 1 where it makes up a fiftieth of the words, 2 at most."""
    return np.minimum(50 * share, 2.0)


@dataclass
class Model:
    """Chosen feature numbers, their weights and the bias."""

    chosen: np.ndarray
    weights: np.ndarray
    bias: float


def _fit(positive: list, unlabelled: list, prior: float, seed: int = 7) -> Model:
    dim = 1 << DIM_BITS
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.int64), np.zeros(0), -30.0 if not positive else 0.0)
    share = np.zeros((2, dim))
    for side, bags in enumerate((positive, unlabelled)):
        for i, _ in bags:
            share[side, i] += 1 / len(bags)
    spread = [(p * (1 - p) + 0.5 / n) / n for p, n in zip(share, (len(positive), len(unlabelled)))]
    signs = (share[0] - share[1]) / np.sqrt(spread[0] + spread[1])  # how surely toxic texts have it more often
    chosen = np.sort(np.argsort(-signs, kind="stable")[:FEATURES])
    place = np.full(dim, -1)
    place[chosen] = np.arange(len(chosen))

    def rows(bags: list) -> list[Rows]:
        parts = np.array_split(np.random.default_rng(seed).permutation(len(bags)), min(BATCHES, len(bags)))
        small = [(place[i[k]], _strength(v[k])) for i, v in bags for k in [place[i] >= 0]]
        return [Rows([small[j] for j in part]) for part in parts]

    p_rows, u_rows, turn = rows(positive), rows(unlabelled), iter(range(STEPS))

    def loss(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        k = next(turn)
        rp, ru = p_rows[k % len(p_rows)], u_rows[k % len(u_rows)]
        gp, gu = rp.dot(w) + b, ru.dot(w) + b
        as_negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        up = prior * sigmoid(gp) / rp.n  # of the toxic texts' risk as negatives
        down = sigmoid(gu) / ru.n
        sign = 1.0 if as_negative >= 0 else -1.0
        fp = -sign * up - (prior * sigmoid(-gp) / rp.n if sign > 0 else 0.0)
        fu = sign * down
        return rp.gradient(fp, len(chosen)) + ru.gradient(fu, len(chosen)), float(fp.sum() + fu.sum())

    w, b = adam(loss, len(chosen), STEPS, RATE, DECAY)
    return Model(chosen, w, b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """A model from label rows of the training folds and texts of the same folds.

    At most MAX_POSITIVE confirmed toxic texts and MAX_UNLABELLED others are
    fitted, chosen by a hash of their id.  The class prior is the share of
    toxic among the training labels; other labels are not used.
    """
    known = labels.where((fold_of(id_col, FOLDS) != HELD) & F.col(label_col).isNotNull())
    prior = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
    order = F.xxhash64(F.col(id_col).cast("string"))
    toxic = known.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct()
    toxic = toxic.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(MAX_POSITIVE)
    train = docs.where(fold_of(id_col, FOLDS) != HELD)
    texts = train.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    others = train.select(F.col(id_col).alias("id"), order.alias("o")).orderBy("o", "id").limit(MAX_UNLABELLED).select("id").distinct()
    chosen = toxic.select("id", F.lit(True).alias("positive")).unionByName(others.select("id", F.lit(False).alias("positive")))
    schema = T.StructType([T.StructField("positive", T.BooleanType()), T.StructField("index", T.BinaryType()),
                           T.StructField("value", T.BinaryType())])
    rows = texts.join(chosen, "id").select("positive", "text").mapInArrow(_bags, schema).collect()
    sides: dict[bool, list] = {True: [], False: []}
    # in one order whatever order the rows arrive in, so that reruns agree
    for flag, index, value in sorted((bool(r["positive"]), bytes(r["index"]), bytes(r["value"])) for r in rows):
        sides[flag].append((np.frombuffer(index, "<i4").astype(np.int64), np.frombuffer(value, "<f4").astype(float)))
    return _fit(sides[True], sides[False], min(max(prior, 1e-4), 0.5))


def _scored(model) -> Callable:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights, bias = model.value
        place = np.full(1 << DIM_BITS, -1)
        place[chosen] = np.arange(len(chosen))
        for batch in batches:
            scores = []
            for _, buf, bounds in text_slices(batch.column(1)):
                found, first = _features(buf, bounds)
                column = place[found]
                word, _ = np.nonzero(column >= 0)
                text = np.searchsorted(first, word, "right") - 1
                pairs, count = np.unique(text * (len(chosen) + 1) + column[column >= 0], return_counts=True)
                text, column = np.divmod(pairs, len(chosen) + 1)
                value = _strength(count / (np.diff(first)[text] + 3))
                total = np.bincount(text, value * weights[column] if len(text) else None, len(first) - 1)
                scores.append(sigmoid(total + bias))
            flat = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flat, pa.float64())], names=["id", "score"])
    return scored


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, score, predicted)`` for every row of ``docs``.

    Null, empty and blank texts get the score of a text without features.
    held_out is false for a null id.  Repeated ids keep a row each.  Other
    columns are ignored.  An empty table gives an empty result; without
    toxic training labels every score is 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast((model.chosen, model.weights, model.bias))
    out = rows.mapInArrow(_scored(shared), T.StructType([T.StructField("id", kind), T.StructField("score", T.DoubleType())]))
    out = out.withColumnRenamed("id", id_col)
    return out.select(id_col, F.coalesce(fold_of(id_col, FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
