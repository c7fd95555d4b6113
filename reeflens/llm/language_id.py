"""Language by hierarchical discrimination: the family first, then the language within it.

Texts are shares of hashed byte n-grams of their letters.  Linear support
vector machines (squared hinge, fitted in numpy on a bounded sample) tell each
family from the rest; within the chosen family one machine per pair of its
languages votes.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import BASE, text_slices
from .linear import Rows, adam, sigmoid
from .scratch import stored
from .toxicity import fold_of

UNKNOWN = "und"
DIM_BITS = 15
GRAMS = (1, 2, 3, 4)
#: Texts per language that are fitted, each whole and as a piece of PIECE bytes.
MAX_TEXTS, PIECE = 200, 160
STEPS, RATE, DECAY = 80, 0.5, 1e-5
FOLDS, HELD = 4, 2
#: Families of common languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "semitic": ("am", "ar", "he", "mt"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}

#: Letters in lower case; every other byte below 128 is a space.
_letter = np.full(256, 32, np.uint64)
_letter[128:] = np.arange(128, 256)
_letter[97:123] = np.arange(97, 123)
_letter[65:91] = np.arange(97, 123)


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def _grams(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature number of the n-gram that begins at every byte, a column per n; the text of every byte.

    -1 where an n-gram would leave its text or begins with two spaces.
    """
    b = _letter[buf]
    high = np.zeros(len(b), bool)  # accented capitals of two bytes
    high[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    b[high] += np.uint64(0x20)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    room = bounds[1:][text] - np.arange(len(b))
    blank = (b == 32) & (np.append(b[1:], 32) == 32)
    out, key = np.full((len(b), len(GRAMS)), -1, np.int32), np.zeros(len(b), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        key[:len(b) - n + 1] |= b[n - 1:] << np.uint64(8 * (n - 1))
        if n in GRAMS:
            h = ((key + np.uint64(n << 40)) * np.uint64(BASE)) >> np.uint64(64 - DIM_BITS)
            out[:, GRAMS.index(n)] = np.where((room >= n) & ~blank, h.astype(np.int32), -1)
    return out, text


def _bag(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    index, count = np.unique(found[found >= 0], return_counts=True)
    return index, count / max(1, len(found))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, index, share): one row for the whole text and one for a piece of it."""
    for batch in batches:
        langs, index, share = [], [], []
        for row, buf, bounds in text_slices(batch.column(1)):
            found, _ = _grams(buf, bounds)
            for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
                middle = max(lo, (lo + hi - PIECE) // 2)
                for a, b in ((lo, hi), (middle, min(hi, middle + PIECE))):
                    i, v = _bag(found[a:b])
                    langs.append(batch.column(0)[row + k].as_py())
                    index.append(i.astype("<i4").tobytes())
                    share.append(v.astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(index, pa.binary()),
                                          pa.array(share, pa.binary())], names=["lang", "at", "share"])


def _machine(rows: Rows, side: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge; both sides (1 and -1) weigh alike, rows at 0 nothing."""
    weight = np.where(side > 0, 0.5 / max(1, (side > 0).sum()), 0.5 / max(1, (side < 0).sum())) * (side != 0)

    def loss(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        slack = np.maximum(0, 1 - side * (rows.dot(w) + b))
        f = -2 * weight * side * slack
        return rows.gradient(f, 1 << DIM_BITS), float(f.sum())

    return adam(loss, 1 << DIM_BITS, STEPS, RATE, DECAY)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All machines from the rows of ``_bags``, as one pickled model."""
    # in one order whatever order the rows arrive in, so that reruns agree
    found = sorted(row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    langs = np.array([r[0] for r in found], dtype=object)
    rows = Rows([(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for _, i, v in found])
    del found  # the sample is held once
    known = sorted(set(langs))
    scale = np.bincount(rows.index, rows.value.astype(float) ** 2, 1 << DIM_BITS)
    scale = np.where(scale > 0, 0.05 / np.sqrt(scale / max(1, rows.n) + 1e-7), 0.0)
    rows.value *= scale[rows.index].astype(np.float32)
    families = sorted({family_of(x) for x in known})
    of = np.array([family_of(x) for x in langs], dtype=object)
    machines, columns = {}, []
    for name in families if len(families) > 1 else []:
        machines["family", name] = _machine(rows, np.where(of == name, 1.0, -1.0))
    for name in families:
        for a, b in combinations([x for x in known if family_of(x) == name], 2):
            machines["pair", a, b] = _machine(rows, (langs == a) * 1.0 - (langs == b) * 1.0)
    for w, _ in machines.values():
        columns.append((w * scale).astype(np.float32))
    weights = np.stack(columns, axis=1) if columns else np.zeros((1 << DIM_BITS, 0), np.float32)
    model = {"langs": known, "families": families, "family": {x: family_of(x) for x in known},
             "machines": {k: (n, b) for n, (k, (_, b)) in enumerate(machines.items())}, "weights": weights}
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Machines from the texts and languages of the training folds.

    At most MAX_TEXTS texts of each language are fitted, chosen by a hash of
    the id, in a task: the driver sees the machines only.  Rows without a
    language, text or id are not learned from.
    """
    train = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    train = train.where((fold_of("id", FOLDS) != HELD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("id").cast("string")), "id")
    ranked = train.select("id", "lang").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= MAX_TEXTS)
    chosen = stored(ranked.select("id", "lang"), "chosen")  # small, and known to be small when texts are joined
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("at", T.BinaryType()),
                           T.StructField("share", T.BinaryType())])
    found = train.join(chosen, ["id", "lang"]).select("lang", "text").mapInArrow(_bags, schema)
    made = found.repartition(1).mapInArrow(_fitted, T.StructType([T.StructField("model", T.BinaryType())]))
    return pickle.loads(made.first()["model"])


def _decide(model: dict, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of texts from the margins of all machines."""
    n, families, langs = len(margins), model["families"], model["langs"]
    margin = lambda *k: margins[:, model["machines"][k][0]] + model["machines"][k][1]
    if len(families) > 1:
        by_family = np.stack([margin("family", f) for f in families], axis=1)
        best = by_family.argmax(axis=1)
        rest = np.sort(by_family, axis=1)
        sure = sigmoid(2 * (rest[:, -1] - rest[:, -2]))
    else:
        best, sure = np.zeros(n, int), np.ones(n)
    lang, score = np.empty(n, dtype=object), np.zeros(n)
    for k, f in enumerate(families):
        own = [x for x in langs if model["family"][x] == f]
        here = best == k
        votes, worst = np.zeros((n, len(own))), np.full((n, len(own)), np.inf)
        for a, b in combinations(range(len(own)), 2):
            m = margin("pair", own[a], own[b])
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            worst[:, a], worst[:, b] = np.minimum(worst[:, a], m), np.minimum(worst[:, b], -m)
        top = np.lexsort((np.broadcast_to(np.arange(len(own)), votes.shape), -worst, -votes), axis=1)[:, 0]
        within = np.ones(n) if len(own) < 2 else sigmoid(4 * worst[np.arange(n), top])
        lang[here] = np.array(own, dtype=object)[top][here]
        score[here] = (sure * within)[here]
    return lang, score


def _languages(m: dict, texts: pa.Array) -> tuple[list, list]:
    """Language and score of every text."""
    langs, scores = [], []
    for _, buf, bounds in text_slices(texts):
        n = len(bounds) - 1
        found, text = _grams(buf, bounds)
        margins = np.zeros((n, m["weights"].shape[1]))
        for c in range(m["weights"].shape[1]):
            w = np.append(m["weights"][:, c], np.float32(0))  # -1 takes the last
            total = sum(w[found[:, k]] for k in range(len(GRAMS)))
            margins[:, c] = np.bincount(text, total, n) / np.maximum(1, np.diff(bounds))
        letter = np.bincount(text, (_letter[buf] != 32) & (buf < 128), n) > 0
        for k in np.flatnonzero(~letter):
            letter[k] = any(x.isalpha() for x in buf[bounds[k]:bounds[k + 1]].tobytes().decode("utf-8", "replace"))
        if m["langs"]:
            lang, score = _decide(m, margins)
        else:
            lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        lang[~letter], score[~letter] = UNKNOWN, 0.0
        langs += lang.tolist()
        scores += score.tolist()
    return langs, scores


def _predicted(model) -> Callable:
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _languages(model.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])
    return predicted


def _confident(model, text: int, least: float) -> Callable:
    def confident(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _languages(model.value, batch.column(text).cast(pa.string()))
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(langs, scores)], pa.bool_()))
    return confident


def keep_known(docs: DataFrame, model: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, whose language is known with a score of ``least`` or more.

    Rows with a null text or a text without a letter go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_confident(shared, docs.columns.index(text_col), least), docs.schema)


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, held_out, lang_pred, score)`` for every row of ``docs``.

    A null text, and a text without a letter, is 'und' with score 0, as is
    every text when no language was learned.  held_out is false for a null id.
    Repeated ids keep a row each.  Other columns are ignored.  An empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.mapInArrow(_predicted(shared), T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType())])).withColumnRenamed("id", id_col)
    return out.select(id_col, F.coalesce(fold_of(id_col, FOLDS) == HELD, F.lit(False)).alias("held_out"), "lang_pred", "score")
