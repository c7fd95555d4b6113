"""Ranked lexical search for many items at once: shared term sets are evaluated once a document.

The items are taken in blocks of a bounded number of terms.  For a block

1. terms held by the same items, as often, form one set (an atom), and the
   items' atoms, ordered from the most to the least shared, form a graph: a
   node is a set of atoms with which one item or many begin, its parent is the
   node without its last atom;
2. every document keeps the block's terms that it holds with their
   frequencies, a small table written once, from which document frequencies
   are counted;
3. a document's terms are added up once an atom and once a node, from the
   parents down, so items that share terms share these sums; an item's score
   is that of its last node.

Each task keeps an item's best documents, and the tasks' best are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .bytewords import text_slices, word_spans
from .scratch import stored
from .sqltext import LOWER, UPPER, whole

K1, B_PERCENT, SCALE = 8, 75, 1_000_000_000
TOP = 10
#: Terms of a block of items: what the driver and each task hold of the items at a time.
BLOCK_TERMS = 1 << 16
#: Sums of nodes held at a time.
CELLS = 1 << 22

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes between terms: all of ASCII but digits and letters.
_between = np.zeros(256, bool)
_between[:128] = [not chr(b).isalnum() for b in range(128)]
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


class Graph(NamedTuple):
    """A block's terms, atoms and nodes; node 0 is the empty set, children come after their parents."""

    terms: pa.Array  # of the vocabulary, as bytes
    atom: np.ndarray  # of each term
    times: list  # (nodes, parents, atoms, repeats) by number of atoms
    items: pa.Array
    last: np.ndarray  # the node of each item


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, term, times)`` of every item with an id."""
    low = F.translate(whole(text_col), UPPER, LOWER)
    each = items.select(F.col(item_col).alias("item"), F.explode_outer(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term"))
    return each.where("item is not null and term is not null").groupBy("item", "term").agg(F.count("*").alias("times"))


def shared_sets(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(term, atom)`` and ``(item, path)`` of ``(item, term, times)``.

    An atom is named by two sums over the items that hold the term, so that no
    group of items is gathered; ``path`` has an item's atoms as (common, atom, times)
    from the most to the least shared.
    """
    signs = [F.sum(F.xxhash64(F.lit(s), "item", "times").cast("decimal(38,0)")) for s in (1, 2)]
    atoms = held.groupBy("term").agg(F.struct(F.count("*").alias("common"), *[x.alias(f"s{i}") for i, x in enumerate(signs)]).alias("atom"))
    atoms = stored(atoms, "atoms")
    each = held.join(atoms, "term").select("item", "atom", "times").distinct()
    paths = each.groupBy("item").agg(F.sort_array(F.collect_list(F.struct(-F.col("atom.common"), F.col("atom"), F.col("times")))).alias("path"))
    return atoms, paths.select("item", "path.atom", "path.times")


def _graph(held: DataFrame, item_type: pa.DataType) -> Graph:
    """The graph of a block, whose size BLOCK_TERMS and the longest item bound."""
    atoms, paths = shared_sets(held)
    number: dict = {}
    terms = sorted((r.term.encode(), tuple(r.atom)) for r in atoms.collect())
    atom = np.array([number.setdefault(a, len(number)) for _, a in terms], np.int64)
    nodes: dict = {}
    levels: list = []
    items, last = [], []
    for row in sorted(paths.collect(), key=lambda r: str(r.item)):
        node = 0
        for depth, step in enumerate(zip(map(tuple, row.atom), row.times)):
            if (node, step) not in nodes:
                nodes[node, step] = len(nodes) + 1
                if depth == len(levels):
                    levels.append([])
                levels[depth].append((nodes[node, step], node, number[step[0]], step[1]))
            node = nodes[node, step]
        items.append(row.item)
        last.append(node)
    return Graph(pa.array([t for t, _ in terms], pa.binary()), atom, [np.array(x, np.int64).T for x in levels],
                 pa.array(items, item_type), np.array(last, np.int64))


def _postings(graph) -> Callable:
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = graph.value.terms
        size = max(1, len(vocabulary))
        for batch in batches:
            lengths, held, counts = [], [], []
            for _, buf, bounds in text_slices(batch.column(1)):
                starts, ends, first = word_spans(buf, bounds, _between)
                # all terms as one Arrow array: their bytes without what is between them
                offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
                data = _lower[buf[~_between[buf]]]
                every = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                found = pc.index_in(every, value_set=vocabulary)
                own = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
                hit = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
                keys, tf = np.unique(own[hit] * size + found.fill_null(0).to_numpy(zero_copy_only=False)[hit], return_counts=True)
                cuts = np.searchsorted(keys, np.arange(1, len(bounds) - 1) * size)
                lengths += np.diff(first).tolist()
                held += np.split((keys % size).astype(np.int32), cuts)
                counts += np.split(tf.astype(np.int32), cuts)
            ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
            flat = [pa.array(np.concatenate([*x, np.zeros(0, np.int32)])) for x in (held, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *[pa.ListArray.from_arrays(ends, x) for x in flat]],
                names=["id", "n", "terms", "tf"])

    return postings


def _sums(graph: Graph, weights: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of all items for some documents, as an array (item, document)."""
    part = weights[term] * ((SCALE * tf) // (1000 * tf + K1 * m[row]))
    of = graph.atom[term]
    order = np.lexsort((row, of))
    key = of[order] * len(m) + row[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    atoms = np.zeros((int(graph.atom.max()) + 1, len(m)), np.int64)
    if len(first):
        atoms.ravel()[key[first]] = np.add.reduceat(part[order], first)
    nodes = np.zeros((1 + sum(x.shape[1] for x in graph.times), len(m)), np.int64)
    for node, parent, atom, times in graph.times:
        nodes[node] = nodes[parent] + times[:, None] * atoms[atom]
    return nodes[graph.last]


def _ranked(graph, weights, top: int) -> Callable:
    def best(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The ``top`` rows of each item, and the score that a further row of the item must reach."""
        n = len(graph.value.items)
        table = table.take(pc.sort_indices(table, sort_keys=[("item", "ascending"), ("score", "descending"), ("id", "ascending")]))
        item = table.column("item").to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        table = table.filter(pa.array(place < top))
        least = np.ones(n, np.int64)
        full = np.flatnonzero(place == top - 1)
        scores = table.column("score").to_numpy()
        least[item[full]] = scores[np.searchsorted(table.column("item").to_numpy(), item[full], "right") - 1]
        return table, least

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, w = graph.value, weights.value
        step = max(1, CELLS // (2 + len(g.atom) + sum(x.shape[1] for x in g.times)))
        kept, least = None, np.ones(len(g.items), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                some = batch.slice(lo, step)
                n = np.diff(some.column(2).offsets.to_numpy())
                row = np.repeat(np.arange(some.num_rows), n)
                term, tf = (some.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                scores = _sums(g, w, row, term, tf, some.column(1).to_numpy())
                item, doc = np.nonzero(scores >= least[:, None])
                if len(item):
                    more = pa.table([pa.array(item), some.column(0).take(pa.array(doc)), pa.array(scores[item, doc])],
                                    names=["item", "id", "score"])
                    kept, least = best(more if kept is None else pa.concat_tables([kept, more]))
        if kept is not None:
            kept = kept.set_column(0, "item", g.items.take(kept.column("item")))
            yield from kept.combine_chunks().to_batches()

    return ranked


def _weight(df: Column, n: Column) -> Column:
    return F.floor(1000 * F.ln((2 * n + 2).cast("double") / (2 * df + 1).cast("double")))


def _block(docs: DataFrame, held: DataFrame, top: int) -> DataFrame:
    """The best documents of one block's items, at least ``top`` of each over all tasks: ``(item, id, score)``."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    item_type, id_type = held.schema["item"].dataType, docs.schema["id"].dataType
    graph = _graph(held, to_arrow_type(item_type))
    shared = sc.broadcast(graph)
    ints = T.ArrayType(T.IntegerType())
    rows = stored(docs.mapInArrow(_postings(shared), T.StructType([
        T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("tf", ints)])), "postings", "zstd")

    n_docs, n_terms = (int(x or 0) for x in rows.where("n > 0").agg(F.count("*"), F.sum("n")).first())
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(max(1, len(graph.atom)), np.int64)  # one number a term of the block
    for r in counted.select("term", _weight(F.col("df"), F.lit(n_docs)).alias("w")).collect():
        weights[r.term] = r.w
    wide = "decimal(38,0)"
    m = F.expr(f"cast({100 - B_PERCENT} + (cast({B_PERCENT * n_docs} as {wide}) * cast(n as {wide})) div cast({max(1, n_terms)} as {wide}) as long)")
    scored = rows.where(F.size("terms") > 0).select("id", m.alias("m"), "terms", "tf").mapInArrow(
        _ranked(shared, sc.broadcast(weights), top), T.StructType([
            T.StructField("item", item_type), T.StructField("id", id_type), T.StructField("score", T.LongType())]))
    return stored(scored, "best")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_col, rank, id_col, score)``: the ``top`` documents of every item with a score above 0.

    Terms are runs of digits, letters and bytes outside ASCII, A-Z in lower
    case.  Scores are sums over the item's terms, repeats included, of the
    term's weight times its saturated frequency (length share B_PERCENT).
    Equal scores rank by id, a null id last.  Null and empty texts have no
    terms: such documents are never found, such items find nothing.  Rows that
    repeat a document's id are documents of their own; rows that repeat an
    item's id are one item with the terms of all; items with a null id are
    left out.  Other columns are ignored.  Empty tables give an empty result.

    Every block of items reads all documents once; no document is skipped.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = stored(item_terms(items, item_col, item_text_col), "item_terms")
    blocks = -(-held.count() // block_terms)
    found = [_block(rows, held.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), top) for b in range(blocks)]
    kinds = T.StructType([T.StructField("item", held.schema["item"].dataType), T.StructField("id", rows.schema["id"].dataType),
                          T.StructField("score", T.LongType())])
    best = docs.sparkSession.createDataFrame([], kinds)
    for part in found:
        best = best.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
