"""Byte-level BPE encoding and decoding: every distinct pre-token of the corpus is encoded once.

1. Texts become blocks of documents.  A block has its distinct pre-tokens; a
   document has, position by position, the numbers of its pre-tokens in them.
2. The blocks' pre-tokens are dealt out and sorted by pre-token, so that equal
   ones of all blocks meet and are encoded once.
3. The ids go back to their blocks, and every document's ids are put together
   by position.

Decoding joins ids with the token-byte table of the vocabulary.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .scratch import stored_by
from .token_counts import _packed, _unpacked

#: A block of documents ends after so many characters of text.
BLOCK_CHARS = 32 << 20
#: So many ids at most go to the workers' output at a time, unless one document has more.
ROWS_IDS = 1 << 20


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The token bytes and ranks of a .tiktoken file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def _file(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _blocks(pattern: str, id_type: pa.DataType) -> Callable:
    names = ["block", "id", "at", "vocabulary"]

    def block(number: int, ids: list, rows: list, known: dict) -> Iterator[pa.RecordBatch]:
        """The documents of a block, then one row with its vocabulary."""
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number] * n, pa.int64()), pa.array(ids, id_type), pa.array(rows, pa.binary()),
             pa.nulls(n, pa.list_(pa.string()))], names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.nulls(1, id_type), pa.nulls(1, pa.binary()),
             pa.array([list(known)], pa.list_(pa.string()))], names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut, serial = regex.compile(pattern).findall, 0
        part = TaskContext.get().partitionId() << 32
        ids, rows, known, held = [], [], {}, 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text, number = text.as_py() or "", known.setdefault
                at = np.array([number(t, len(known)) for t in cut(text)], np.uint32)
                ids.append(key.as_py())
                rows.append(_packed(at))
                held += len(text)
                if held >= BLOCK_CHARS:
                    yield from block(part + serial, ids, rows, known)
                    ids, rows, known, held, serial = [], [], {}, 0, serial + 1
        if rows:
            yield from block(part + serial, ids, rows, known)

    return blocks


def _encoded(ranks, pattern: str) -> Callable:
    """Sorted rows (token, block, at) to (block, at, n, ids): of each block's pre-tokens of a batch, their ids one after the other."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        code = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks.value), special_tokens={})
        last, last_ids = None, []
        for batch in batches:
            once = batch.column(0).dictionary_encode()
            found = []
            for token in once.dictionary.to_pylist():
                if token != last:  # the last pre-token of a batch may go on in the next
                    last, last_ids = token, code.encode_ordinary(token)
                found.append(last_ids)
            n = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(n.sum()))
            first = np.cumsum(n) - n
            of, block = once.indices.to_numpy(), batch.column(1).to_numpy()
            at = batch.column(2).to_numpy().astype(np.uint32)
            order = np.lexsort((at, block))
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            rows = np.split(order, cuts) if len(order) else []
            out = [(block[r[0]], _packed(np.diff(at[r], prepend=np.uint32(0))), _packed(n[of[r]].astype(np.uint32)),
                    _packed(_gather(flat, first[of[r]], n[of[r]]))) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x[0]) for x in out], pa.int64()), *[pa.array([x[i] for x in out], pa.binary()) for i in (1, 2, 3)]],
                names=["used_in", "at", "n", "ids"])

    return encoded


def _gather(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``first`` and have ``n`` values, one after the other."""
    n = n.astype(np.int64)
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(first - (ends - n), n) + np.arange(total)]


def _listed(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*values, np.zeros(0, np.int32)]).astype(np.int32)))


def _placed(docs: pa.Table, words: pa.Table) -> pa.Table:
    """The documents of one block with their ids; ``words`` has those of its pre-tokens."""
    at, n, ids = [[_unpacked(x.as_py()) for x in words.column(c)] for c in ("at", "n", "ids")]
    size = sum(map(len, at))
    count, first, flat = np.zeros(size, np.int64), np.zeros(size, np.int64), np.concatenate([*ids, np.zeros(0, np.uint32)])
    begin = 0
    for where, many, own in zip(at, n, ids):
        where, many = np.cumsum(where), many.astype(np.int64)
        count[where], first[where] = many, begin + np.cumsum(many) - many
        begin += len(own)
    keys, chunks, held, total = docs.column("id").combine_chunks(), [], [], 0
    for row, where in enumerate(docs.column("at")):
        index = _unpacked(where.as_py())
        held.append(_gather(flat, first[index], count[index]))
        total += len(held[-1])
        if total >= ROWS_IDS or row == docs.num_rows - 1:
            chunks.append((row + 1, _listed(held)))
            held, total = [], 0
    kind = pa.schema([pa.field("id", keys.type), pa.field("ids", pa.list_(pa.int32()))])
    starts = [0, *[end for end, _ in chunks]]
    return pa.Table.from_batches([pa.RecordBatch.from_arrays([keys.slice(a, b - a), x], schema=kind)
                                  for a, (b, x) in zip(starts, chunks)], schema=kind)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)`` for every row of ``docs``: the token ids of the whole text, in order.

    ``ranks_path`` is a .tiktoken file that the driver can read, a vocabulary
    of bounded size; ``pattern`` cuts texts into pre-tokens, each encoded by
    itself.  There are no special tokens: their strings are ordinary text.
    Null and empty texts have an empty array.  Null and repeated ids keep a
    row each.  Other columns are ignored.  An empty table gives an empty result.
    """
    ranks = _file(docs, ranks_path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    # in buckets by block: a document's positions are written once and go into no exchange
    blocks = stored_by(rows.mapInArrow(_blocks(pattern, to_arrow_type(kind)), T.StructType([
        T.StructField("block", T.LongType()), T.StructField("id", kind), T.StructField("at", T.BinaryType()),
        T.StructField("vocabulary", T.ArrayType(T.StringType()))])), "blocks", "block", "zstd")

    used = blocks.where("vocabulary is not null").select("block", F.posexplode_outer("vocabulary").alias("at", "token"))
    used = used.where("token is not null").select("token", "block", "at")
    # a pre-token comes once from a block, so that none has a large share of the rows
    words = used.repartition("token").sortWithinPartitions("token").mapInArrow(_encoded(ranks, pattern), T.StructType([
        T.StructField("used_in", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in ("at", "n", "ids")]]))
    per_doc = blocks.where("at is not null").select("block", "id", "at")
    out = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return per_doc.groupBy("block").cogroup(words.groupBy("used_in")).applyInArrow(_placed, out).withColumnRenamed("id", id_col)


def _decoded(ranks, column: int) -> Callable:
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read_ranks(ranks.value)
        size = max(table.values(), default=-1) + 1
        n, tokens = np.full(size, -1, np.int64), [b""] * size
        for token, rank in table.items():
            n[rank], tokens[rank] = len(token), token
        first = np.cumsum(np.maximum(n, 0)) - np.maximum(n, 0)
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            out = []
            for ids in batch.column(column):
                index = np.zeros(0, np.int64) if ids.values is None else ids.values.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(index) and (index.min() < 0 or index.max() >= size or n[index].min() < 0):
                    raise ValueError("an id is not in the vocabulary")
                out.append(_gather(flat, first[index], n[index]).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return decoded


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids; null and empty arrays give no bytes.

    The bytes are binary: ids need not make up valid UTF-8.  An id that the
    vocabulary does not have is an error.  A column ``decoded`` of the input is
    replaced, all others stay.  An empty table gives an empty result.
    """
    rows = encoded.drop("decoded")
    kind = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(_decoded(_file(encoded, ranks_path), rows.columns.index(ids_col)), kind)
