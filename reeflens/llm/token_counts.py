"""Exact token counts: pieces are counted once for each distinct pre-token of the corpus.

1. Texts become blocks of documents: each block has the distinct pre-tokens of
   its texts and, per document, their frequencies.
2. The blocks' pre-tokens are dealt out and sorted by pre-token, so that each
   distinct one is encoded once (again only where a batch ends among its rows).
3. The piece counts go back to their blocks, and each document sums frequency
   times pieces.  No list of token ids is made for any text.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .scratch import stored

#: A block of documents ends after so many characters of text.
BLOCK_CHARS = 16 << 20
#: Characters whose normal form, case and classes are the same in every Unicode version:
#: the common ones of Latin text.  Other texts take the library's own normaliser and splitter.
PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-įĲ-ɏ]*"


def _splitter(model: str) -> Callable[[str], tuple[list[str], int]]:
    """A function from text to (pre-tokens, number of special strings), as the tokenizer splits."""
    import regex
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    spec = json.loads(model)
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    if split["type"] != "Split" or not split["invert"] or split["behavior"] != "Removed":
        raise ValueError("only a tokenizer that keeps the matches of one pattern is supported")
    pattern = regex.compile(split["pattern"]["Regex"])
    own = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), "removed", invert=True)
    small = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}
    normalizer = Tokenizer.from_str(json.dumps(small)).normalizer
    plain = regex.compile(PLAIN)
    special = [t["content"] for t in spec["added_tokens"]]
    cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def pieces(text: str) -> list[str]:
        if plain.fullmatch(text):
            return pattern.findall(text.lower())
        return [t for t, _ in own.pre_tokenize_str(normalizer.normalize_str(text))]

    def tokens(text: str) -> tuple[list[str], int]:
        if cut is None or not cut.search(text):
            return pieces(text), 0
        parts = cut.split(text)
        return [t for part in parts for t in pieces(part)], len(parts) - 1

    return tokens


def _packed(values: np.ndarray) -> bytes:
    """Non-negative 32-bit values, the first bytes of all before the second bytes of all, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _blocks(model, id_type: pa.DataType) -> Callable:
    names = ["block", "id", "n_bytes", "extra", "index", "count", "vocabulary"]

    def block(number: int, ids: list, rows: list, known: dict) -> Iterator[pa.RecordBatch]:
        """The documents of a block, then one row with its vocabulary."""
        n = len(rows)
        size, extra, index, count = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number] * n, pa.int64()), pa.array(ids, id_type), pa.array(size, pa.int64()),
             pa.array(extra, pa.int64()), pa.array(index, pa.binary()), pa.array(count, pa.binary()),
             pa.nulls(n, pa.list_(pa.string()))], names=names)
        empty = [pa.nulls(1, t) for t in (id_type, pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *empty, pa.array([list(known)], pa.list_(pa.string()))], names=names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, serial = _splitter(model.value), 0
        part = TaskContext.get().partitionId() << 32

        ids, rows, known, held = [], [], {}, 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, text = key.as_py(), text.as_py()
                found, extra = tokens(text or "")
                bag = Counter(found)
                index = np.fromiter((known.setdefault(t, len(known)) for t in bag), np.uint32, len(bag))
                order = np.argsort(index)
                count = np.fromiter(bag.values(), np.uint32, len(bag))
                ids.append(key)
                rows.append((len((text or "").encode()), extra,
                             _packed(np.diff(index[order], prepend=np.uint32(0))), _packed(count[order])))
                held += len(text or "")
                if held >= BLOCK_CHARS:
                    yield from block(part + serial, ids, rows, known)
                    ids, rows, known, held, serial = [], [], {}, 0, serial + 1
        if rows:
            yield from block(part + serial, ids, rows, known)

    return blocks


def _encoded(model) -> Callable:
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one thread
        pieces = Tokenizer(Tokenizer.from_str(model.value).model)  # no normaliser, no special strings
        pieces.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for batch in batches:
            once = batch.column(2).dictionary_encode()
            sizes = []
            for at in range(0, len(once.dictionary), 1000):
                found = pieces.encode_batch(once.dictionary[at:at + 1000].to_pylist(), add_special_tokens=False)
                sizes += [len(x.ids) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()).take(once.indices)],
                names=["used_in", "at", "pieces"])

    return encoded


def _summed(docs: pa.Table, pieces: pa.Table) -> pa.Table:
    """Documents of one block with their sums; ``pieces`` has the piece count of each index."""
    of = np.zeros(pieces.num_rows, np.int64)
    of[pieces.column("at").to_numpy()] = pieces.column("pieces").to_numpy()
    sums = []
    for index, count, extra in zip(docs.column("index"), docs.column("count"), docs.column("extra")):
        found = of[np.cumsum(_unpacked(index.as_py()))] * _unpacked(count.as_py())
        sums.append(int(found.sum()) + extra.as_py())
    return pa.table([docs.column("id"), docs.column("n_bytes"), pa.array(sums, pa.int64())], names=["id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` for every row of ``docs``.

    ``model_path`` is a tokenizers .json file that the driver can read.  Begin,
    end and added special tokens are not counted, special strings inside a
    text are one token each (the library's default), nothing is cut or padded.
    Null and empty texts have 0 tokens.  Null and repeated ids keep a row
    each.  Other columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(model_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("id", kind), T.StructField("n_bytes", T.LongType()),
        T.StructField("extra", T.LongType()), T.StructField("index", T.BinaryType()), T.StructField("count", T.BinaryType()),
        T.StructField("vocabulary", T.ArrayType(T.StringType()))])
    blocks = stored(rows.mapInArrow(_blocks(model, to_arrow_type(kind)), schema), "blocks")

    used = blocks.where("vocabulary is not null").select(
        F.col("block").alias("used_in"), F.posexplode_outer("vocabulary").alias("at", "token"))
    used = used.where("token is not null")
    # equal pre-tokens of all blocks meet, one after the other; a pre-token comes once from a block,
    # so that none has a large share of the rows
    known = used.repartition("token").sortWithinPartitions("token").mapInArrow(_encoded(model), T.StructType([
        T.StructField("used_in", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("pieces", T.LongType())]))
    per_doc = blocks.where("vocabulary is null").select("block", "id", "n_bytes", "extra", "index", "count")
    out = T.StructType([T.StructField("id", kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return per_doc.groupBy("block").cogroup(known.groupBy("used_in")).applyInArrow(_summed, out).withColumnRenamed("id", id_col)
