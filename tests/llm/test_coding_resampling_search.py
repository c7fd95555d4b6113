"""BPE coding against the library, importance resampling and ranked search against plain versions."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import as_docs

SMALL = "/root/testdata/sf0.001"
TRICKY = ["don't  stop\n\n  now ", "  x  y", "日本語と한국어 и кириллица 😀😀👍🏽", "a" * 3000, "<|endoftext|>", "\x00\x1c\x85z",
          "1234567 12,5", "\r\n\r\n", "é ﬁ ǅ", " "]


def ranks_and_pattern():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    import tiktoken
    path, pattern = ranks_and_pattern()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_ids_match_the_library_and_decode_to_the_text(spark, unruly, nothing, library, monkeypatch):
    from reeflens.llm import bpe_coding
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    tricky = as_docs(spark, [(i, t, None, None) for i, t in enumerate(TRICKY)])
    for chars in (bpe_coding.BLOCK_CHARS, 40_000):  # one block, many blocks
        monkeypatch.setattr(bpe_coding, "BLOCK_CHARS", chars)
        for df in (unruly, tricky, small):
            coded = bpe_coding.decode(bpe_coding.encode(df, *ranks_and_pattern()), ranks_and_pattern()[0])
            got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in coded.collect()), key=str)
            exp = [(d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t in texts_of(df)]
            assert got == sorted(exp, key=str)
    assert bpe_coding.encode(nothing, *ranks_and_pattern()).count() == 0


def test_decode_takes_any_ids(spark):
    from reeflens.llm.bpe_coding import decode
    path = ranks_and_pattern()[0]
    df = spark.createDataFrame([(1, [0, 255], "x"), (2, [], "x"), (3, None, "x")], "k int, ids array<int>, decoded string")
    out = {r.k: bytes(r.decoded) for r in decode(df, path).collect()}
    assert len(out[1]) == 2 and out[2] == out[3] == b"" and decode(df, path).columns == ["k", "ids", "decoded"]
    assert decode(df.where("false"), path).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        decode(spark.createDataFrame([([70000],)], "ids array<int>"), path).collect()


def test_coding_query(spark, library):
    from reeflens.llm.queries import QUERIES
    docs = dict(texts_of(spark.read.parquet(f"{SMALL}/documents.parquet")))
    rows = QUERIES["op11_byte_bpe"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def ngrams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or ""))
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_crcs_of_ngrams():
    from reeflens.llm.importance import Shifts, ngram_crcs, of_text
    texts = ["Ab c9 d", "", "one", "é" * 700 + " x " + "y" * 300 + ",z", "--", "A" * 70000 + " b c", "tail"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *[len(t.encode()) for t in texts]])
    first, crcs = ngram_crcs(buf, bounds, Shifts(), 3)
    for i, t in enumerate(texts):
        assert of_text(first, crcs, i).tolist() == [zlib.crc32(g.encode()) for g in ngrams(t)[1]]
    none = ngram_crcs(np.zeros(0, np.uint8), np.array([0, 0]), Shifts(), 3)
    assert len(of_text(*none, 0)) == 0


def test_resampling_matches_brute_force(spark, unruly, nothing):
    from reeflens.llm.importance import resample
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    target = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    none = target.where("false")
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    for df, aims, percent in ((small, target, 5), (unruly, target, 50), (unruly, none, 100)):
        rows, goal = texts_of(df), [r.text for r in aims.collect()]
        found = [ngrams(t) for _, t in rows]
        s, t = Counter(bucket(g) for _, gs in found for g in gs), Counter(bucket(g) for x in goal for g in ngrams(x)[1])
        total_s, total_t = sum(s.values()) + 10000, sum(t.values()) + 10000
        gain = {b: math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t))) for b in s}
        exp = []
        for (d, _), (n, gs) in zip(rows, found):
            h = int(hashlib.sha256(f"42:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
            weight = sum(gain[bucket(g)] for g in gs)
            exp.append((n >= 20, d, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        long = sorted((x for x in exp if x[0]), key=lambda x: (-x[4], x[1] is None, x[1] or 0))
        drawn = percent * len(long) // 100
        want = [(*x[1:], k + 1 if k < drawn else None) for k, x in enumerate(long)] + [(*x[1:], None) for x in exp if not x[0]]
        assert sorted(map(tuple, resample(df, aims, percent=percent).collect()), key=str) == sorted(want, key=str)
    assert resample(nothing, target).count() == 0


def test_resampling_ranks_over_partitions(spark):
    """Equal scores of repeated rows, far more rows than partitions, another number of buckets."""
    from reeflens.llm.importance import resample
    rows = [(i // 3, " ".join(f"w{(i // 3 * k) % 97}" for k in range(25)), None, None) for i in range(600)]
    out = resample(as_docs(spark, rows), as_docs(spark, rows[:9]), percent=40, buckets=70_000).collect()
    drawn = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 241))
    assert [(r.score, r.doc_id) for r in drawn] == sorted(((r.score, r.doc_id) for r in out), key=lambda x: (-x[0], x[1]))[:240]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text or ""))


def best(docs, items, top=10):
    """(item, rank, id, score) by adding up every term of every pair."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, df = sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(terms(t))
    for i, bag in asked.items():
        scores = []
        for d, b, n in bags:
            m = 25 + 75 * n * len(bags) // total
            score = sum(c * math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                        for t, c in bag.items() if t in b)
            scores += [(-score, d is None, d or 0)] if score > 0 else []
        for k, (s, none, d) in enumerate(sorted(scores)[:top]):
            yield i, k + 1, None if none else d, -s


def test_search_matches_brute_force(spark, unruly, nothing, monkeypatch):
    from reeflens.llm import ranked_search
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    asked = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    odd = spark.createDataFrame([(1, "alpha1 Beta2 beta2 beta2 gamma3"), (2, "gamma3 alpha1"), (2, "mu5 one"), (3, None), (4, " ., "),
                                 (None, "alpha1"), (5, "nowhere"), (6, "épsilon7 12 34"), (7, "alpha1 Beta2 beta2 beta2 gamma3 mu5")], "item_id long, text string")
    for df, items, block, cells in ((small, asked, 1 << 16, 1 << 22), (small, asked, 500, 5000), (unruly, odd, 1 << 16, 1 << 22), (unruly, odd, 3, 1)):
        monkeypatch.setattr(ranked_search, "CELLS", cells)
        exp = best(texts_of(df), [(r.item_id, r.text) for r in items.collect()])
        got = ranked_search.search(df, items, block_terms=block)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(exp, key=str)
    assert ranked_search.search(nothing, odd).count() == 0 and ranked_search.search(unruly, odd.where("false")).count() == 0


def test_search_shares_what_items_have_in_common(spark):
    """Equal items end in one node; terms that only go together are one atom."""
    import pyarrow as pa

    from reeflens.llm.ranked_search import _graph, item_terms
    common = " ".join(f"shared{i}" for i in range(30))
    items = spark.createDataFrame([(i, f"{common} own{i // 2} own{i // 2}x") for i in range(40)], "item_id long, text string")
    graph = _graph(item_terms(items, "item_id", "text"), pa.int64())
    assert len(graph.terms) == 70 and len(set(graph.atom)) == 21
    assert sum(x.shape[1] for x in graph.times) == 21 and len(set(graph.last)) == 20


def test_search_ranks_ties_by_id(spark):
    from reeflens.llm.ranked_search import search
    docs = as_docs(spark, [(200 - i, "same text of many copies", None, None) for i in range(150)] + [(i + 1000, f"other{i}", None, None) for i in range(200)])
    items = spark.createDataFrame([(1, "copies")], "item_id long, text string")
    rows = sorted(search(docs, items).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.doc_id) for r in rows] == [(k + 1, 51 + k) for k in range(10)]
