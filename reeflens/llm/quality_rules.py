"""Quality rules over documents: base counts, and line frequency across the documents of a host.

Lines are hashed after normalisation (lower case, white space folded); a line
found in more than ``MAX_DOCS`` distinct documents of one host is removed,
and a document that loses more than ``1 - MIN_SHARE`` of its words is
rejected as depleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .sqltext import WORD, whole, words

MAX_DOCS = 30
MIN_SHARE = 0.5
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Low bits of a packed value hold a word's index, the others bits of a hash.
_INDEX_BITS = 26
_INDEX = (1 << _INDEX_BITS) - 1


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _windows(w: str) -> Column:
    """Hash of every 3-word window."""
    i_max = F.size(w) - 3
    return F.when(i_max >= 0, F.transform(F.sequence(F.lit(0), i_max), lambda i: F.xxhash64(
        F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))))


def _packed(h: str) -> Column:
    """Sorted values of hash bits over an index, which bring equal windows side by side."""
    return F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~_INDEX)).bitwiseOR(i.cast("long"))))


def _repeated(k: str, h: str) -> Column:
    """Sorted start indices of the windows that the text has twice or more."""
    at = lambda x: F.get(F.col(h), x.bitwiseAND(F.lit(_INDEX)).cast("int"))
    same = lambda x, y: (F.shiftright(x.bitwiseXOR(y), _INDEX_BITS) == 0) & (at(x) == at(y))
    twice = F.filter(k, lambda x, i: F.coalesce(same(x, F.get(F.col(k), i - 1)), F.lit(False))
                     | F.coalesce(same(x, F.get(F.col(k), i + 1)), F.lit(False)))
    return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(F.lit(_INDEX))))


def _covered(starts: str) -> Column:
    """Words in the 3-word windows that begin at the given sorted indices."""
    new = F.transform(starts, lambda p, j: F.when(j == 0, F.lit(3).cast("long")).otherwise(
        F.least(F.lit(3).cast("long"), p - F.get(F.col(starts), j - 1))))
    return F.coalesce(F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))


def _parsed(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: the base counts and (hash, words) of every line with a word."""
    df = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), whole(text_col).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    df = df.select("id", "host", "t", words(F.col("t")).alias("w"), lines.alias("l"))
    df = df.select("*", _windows("w").alias("h"), F.transform("l", lambda x: words(F.lower(x))).alias("lw"))
    df = df.select("*", _packed("h").alias("k")).select("*", _repeated("k", "h").alias("r"))
    return df.select(
        "id", "host", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _covered("r").alias("n_repeat_words"),
        F.transform("lw", lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(x).alias("words"))).alias("lines"))


def quality(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``n_removed_words`` and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than MIN_WORDS words, or more than half of them in
    repeated 3-word windows.  ``kept`` is false for those and for depleted
    documents.  A null or empty text has no words and fails.  A null host is a
    host of its own.  Rows that repeat an id are one document when documents
    are counted; the lines of a row with a null id are not counted or removed.
    Texts of up to 2**26 words are counted exactly.  Other columns are ignored.
    An empty table gives an empty result.
    """
    parsed = stored(_parsed(docs, id_col, host_col, text_col), "parsed")
    lines = parsed.where("id is not null").select("id", "host", F.explode_outer("lines").alias("l")).where("l is not null")
    lines = lines.select("id", "host", "l.line", "l.words").groupBy("host", "line", "id").agg(F.sum("words").alias("words"))
    lines = stored(lines, "lines")
    frequent = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > MAX_DOCS)
    on = (F.col("a.line") == F.col("f.line")) & F.col("a.host").eqNullSafe(F.col("f.host"))
    removed = lines.alias("a").join(frequent.alias("f"), on, "left_semi").groupBy("id", "host").agg(
        F.sum("words").alias("n_removed_words"))
    out = parsed.drop("lines").alias("p").join(removed.alias("r"), (F.col("p.id") == F.col("r.id"))
                                               & F.col("p.host").eqNullSafe(F.col("r.host")), "left")
    gone = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        F.col("p.id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("n_removed_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - gone >= MIN_SHARE * F.col("n_words"))).alias("kept"))
