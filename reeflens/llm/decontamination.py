"""Benchmark decontamination: size-partitioned MinHash containment search.

A document's 5-word shingle hashes are sketched by one-permutation MinHash:
the hash range is cut into bins and each bin keeps its minimum.  Documents are
partitioned by size (powers of two) and the bins grow with the partition, at
least one for each shingle, so a short item is found in a long document as
well as in a short one.  Bins of the partitions nest, so one row per item
shingle tells from which partition on it is the minimum of its bin; an item is
a candidate where one of its minima is a minimum of the document.  A contained
shingle is a minimum with probability 0.63 or more, so an item of ``SHORT``
shingles or more is missed with probability 0.37**(0.8 * SHORT) at most, about 1e-7.
Shorter items are looked up by all shingles.  An item of fewer than WIDTH words is
one shingle of them all and is looked up among the runs of as many words; only the
lengths that items have are looked for.  Candidates are verified by the exact
containment of their shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .sqltext import whole, words

WIDTH = 5
THRESHOLD_PERCENT = 80
SHORT = 20


def _runs(w: str, make, width: int) -> Column:
    """``make`` of every run of ``width`` words, filled up to WIDTH with empty ones; none if there are fewer words."""
    word = lambda i, k: F.get(F.col(w), i + k) if k < width else F.lit("")
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: make(*[word(i, k) for k in range(WIDTH)]))
    return F.when(F.size(w) >= width, runs).otherwise(F.filter(F.array(make(*[F.lit("")] * WIDTH)), lambda _: F.lit(False)))


def _shingles(w: str, make) -> Column:
    """The runs of WIDTH words of an item; of all its words if it has fewer; none without words."""
    own = F.when(F.size(w) >= WIDTH, _runs(w, make, WIDTH))
    for width in range(1, WIDTH):
        own = own.when(F.size(w) == width, _runs(w, make, width))
    return own


# The outer form of explode below keeps the optimizer from testing the array for
# emptiness first, in a filter that repeats the array's whole expression.


def _words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), words(F.lower(whole(text_col))).alias("w")).where("id is not null")


def _joined(*parts: Column) -> Column:
    """Words joined by spaces; a space is in no word, so they are told apart."""
    return F.rtrim(F.concat_ws(" ", *parts))


def _distinct(rows: DataFrame, shingles: Column) -> DataFrame:
    return rows.select("id", F.explode_outer(F.array_distinct(shingles)).alias("shingle")).where("shingle is not null").distinct()


def _minima(hashed: DataFrame) -> DataFrame:
    """(id, p, h): the minimum of every filled bin, with 2**p bins for up to 2**p shingles."""
    level = F.greatest(F.lit(1), F.length(F.bin((F.size("hashes") - 1).cast("long")))).cast("int")
    ranked = hashed.select("id", level.alias("p"), F.sort_array("hashes").alias("s"))
    first = F.filter("s", lambda x, i: (i == 0) | (
        F.call_function("shiftrightunsigned", x.bitwiseXOR(F.get(F.col("s"), i - 1)), F.lit(64) - F.col("p")) != 0))
    return ranked.select("id", "p", F.explode_outer(first).alias("h"))


def _item_minima(items: DataFrame) -> DataFrame:
    """(h, item, n, p0): the item's shingles; from partition p0 on, h is the minimum of its bin.

    That is one more than the leading bits that h shares with the next smaller hash.
    """
    ranked = items.select("id", F.array_sort(F.array_distinct("hashes")).alias("s"))
    shared = lambda x, i: F.lit(64) - F.length(F.bin(x.bitwiseXOR(F.get(F.col("s"), i - 1))))
    pairs = F.transform("s", lambda x, i: F.struct(
        x.alias("h"), F.when(i == 0, F.lit(0)).otherwise(shared(x, i) + 1).alias("p0")))
    return ranked.select(F.col("id").alias("item"), F.size("s").alias("n"), F.inline_outer(pairs)).where("h is not null")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id_col, item_col, n_item, n_shared, containment)``: items contained in documents.

    ``n_item`` counts the item's distinct shingles, ``n_shared`` those that the
    document has; rows have ``100 * n_shared >= THRESHOLD_PERCENT * n_item``.
    Words are runs without white space in lower case.  An item with fewer than
    WIDTH words has one shingle, all its words, which a document has wherever
    they stand in a row; texts without words match nothing.  Rows that repeat an id are one text with the shingles of all of
    them; rows with a null id are not searched.  Other columns are ignored.
    Empty tables give an empty result.
    """
    asked = stored(_words(items, item_col, item_text_col), "items")
    # the lengths of items under WIDTH words: at most WIDTH - 1 numbers
    widths = [WIDTH, *sorted(r.k for r in asked.select(F.size("w").alias("k")).where(F.col("k").between(1, WIDTH - 1)).distinct().collect())]
    of_docs = lambda w, make: F.concat(*[_runs(w, make, k) for k in widths])
    rows = _words(docs, id_col, text_col)
    hashed = rows.select("id", _runs("w", F.xxhash64, WIDTH).alias("hashes"))
    index = stored(_item_minima(asked.select("id", _shingles("w", F.xxhash64).alias("hashes"))), "item_hashes")
    long = index.where(F.col("n") >= SHORT).select("h", "item", "p0")
    short = index.where(F.col("n") < SHORT).select("h", "item")
    found = _minima(hashed).join(long, "h").where("p >= p0").select("id", "item")
    found_short = rows.select("id", F.explode_outer(of_docs("w", F.xxhash64)).alias("h")).join(short, "h").select("id", "item")
    candidates = stored(found.unionByName(found_short).distinct(), "candidates")

    probes = stored(_distinct(asked, _shingles("w", _joined)), "item_shingles")
    sizes = probes.groupBy("id").agg(F.count("*").alias("n_item"))
    probes = probes.join(sizes, "id").select(F.col("id").alias("item"), "shingle", "n_item")
    ids = candidates.select(F.col("id").alias(id_col)).distinct()
    texts = docs.select(id_col, text_col).join(ids, id_col, "left_semi")
    hits = _distinct(_words(texts, id_col, text_col), of_docs("w", _joined)).join(probes, "shingle").join(candidates, ["id", "item"], "left_semi")
    counts = hits.groupBy("id", "item", "n_item").agg(F.count("*").alias("n_shared"))
    return counts.where(100 * F.col("n_shared") >= THRESHOLD_PERCENT * F.col("n_item")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "n_item", "n_shared",
        (F.col("n_shared") / F.col("n_item")).alias("containment"))
