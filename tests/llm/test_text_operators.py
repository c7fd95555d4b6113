"""Line dedup, passage removal, near duplicates, decontamination and token counts against plain versions."""

import brute
import pytest
from conftest import as_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def pairs(rows):
    return [(d, t) for d, t, *_ in rows]


def test_lines_match_brute_force(odd, odd_rows, small):
    from reeflens.llm.line_dedup import line_report
    for df, rows in ((odd, pairs(odd_rows)), small):
        got = {(r.doc_id, no) for r in line_report(df).collect() for no in r.removed}
        exp = brute.removed_lines(rows)
        # banding misses a pair at the threshold with probability 0.01, none of these tables'
        assert got == exp


def test_lines_report_every_document(unruly, nothing):
    from reeflens.llm.line_dedup import dedup_lines, line_report
    rows = {r.doc_id: r for r in line_report(unruly).collect()}
    assert set(rows) == {None, *range(1, 17)}
    assert rows[None].n_removed == 0 and rows[4].n_lines == 1 and rows[4].n_removed == 0
    assert rows[7].n_removed == 0 and rows[8].n_removed == 1  # "one" and "ONE"
    assert rows[10].removed == [] and rows[11].n_removed == 8
    assert line_report(nothing).count() == 0 and dedup_lines(nothing).count() == 0


def test_lines_leave_the_text(unruly):
    from reeflens.llm.line_dedup import dedup_lines
    out = dedup_lines(unruly)
    assert out.columns == unruly.columns
    texts = {r.doc_id: r.text for r in out.where("doc_id is not null and doc_id <> 1").collect()}
    assert 8 not in texts and texts[11].startswith("more ") and texts[4] is None and texts[5] == ""
    assert texts[16].count("\n") == 0  # the line once instead of three times


def test_repeats_match_brute_force(spark, odd, odd_rows, unruly, nothing, small):
    from reeflens.llm.suffix_dedup import remove_repeats
    long = "".join(chr(97 + (i * i // 7) % 23) for i in range(1500))
    edges = [(1, "a" * 1200), (2, "a" * 399), (3, "a" * 400), (4, "ab" * 500), (5, long), (6, "xy" + long[100:499]),
             (7, "xy" + long[100:500]), (8, long[:700] + "Z" + long[700:]), (9, "é" * 300 + long[900:]), (9, "é" * 250)]
    edge_df = as_docs(spark, [(d, t, None, None) for d, t in edges])
    every = [(r.doc_id, r.text) for r in unruly.select("doc_id", "text").collect()]
    for df, rows in ((odd, pairs(odd_rows)), (unruly, every), (edge_df, edges), small):
        assert sorted(map(tuple, remove_repeats(df).collect()), key=str) == brute.repeats(rows)
    assert remove_repeats(nothing).count() == 0


def test_near_match_brute_force(odd, odd_rows, small):
    from reeflens.llm.near_dedup import near_duplicates
    for df, rows in ((odd, pairs(odd_rows)), small):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}
        assert got == brute.near(rows)


def test_near_sets_of_one_name_stay_apart(small, odd, odd_rows, monkeypatch):
    """Hundreds of sets share 40 names at first, and some of the new ones clash again."""
    from pyspark.sql import functions as F

    from reeflens.llm import near_dedup

    def narrow(salt=0):
        names = F.xxhash64("n", "p1", "p2", F.lit(salt))
        return F.pmod(names, F.lit(40 if not salt else 2000)) if salt < 2 else names

    monkeypatch.setattr(near_dedup, "_name", narrow)
    for df, rows in (small, (odd, pairs(odd_rows))):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
        assert got == brute.near(rows)


def test_components_of_paths_and_stars(spark):
    from reeflens.llm.components import components
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(1, k) for k in range(2, 30)] + [(29, 31), (50, 31), (7, 7), (None, 3)]
    df = spark.createDataFrame(path + star, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, **{k: 1 for k in [*range(1, 30), 31, 50]}}
    assert components(df.where("false")).count() == 0


def test_near_groups_and_unruly_rows(spark, unruly, nothing):
    from reeflens.llm.near_dedup import near_duplicates
    out = near_duplicates(unruly).collect()
    assert len(out) == unruly.count() and near_duplicates(nothing).count() == 0
    assert all(r.kept and r.component_id is None for r in out if r.doc_id is None)
    # a group whose members differ from one text in other places, with members that are linked to few
    words = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(60):
        w = list(words)
        for k in range(d % 14):
            w[(17 * d + 13 * k) % 200] = f"x{d}_{k}"
        rows.append((d, " ".join(w), None, None))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(as_docs(spark, rows)).collect()}
    assert got == brute.near(pairs(rows))


def test_near_rows_of_one_id_are_one_node(spark):
    """An id with several texts links the groups of all of them, in any order of the rows."""
    from reeflens.llm.near_dedup import near_duplicates
    text = lambda k, change="": " ".join(f"{k}{i}" for i in range(100)) + change
    rows = [(3, text("a")), (3, text("b")), (1, text("a", " x")), (2, text("b", " x")), (2, ""), (2, text("c")), (4, text("c", " x")),
            (5, text("d")), (6, text("d")), (7, ""), (7, text("e"))]
    for order in (rows, rows[::-1]):
        docs = as_docs(spark, [(d, t, None, None) for d, t in order])
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
        assert [(d, c, k) for d, _, c, k in got] == [(1, 1, True)] + [(2, 1, False)] * 3 + [(3, 1, False)] * 2 + [
            (4, 1, False), (5, 5, True), (6, 5, False), (7, 7, True), (7, 7, True)]


def test_contained_match_brute_force(spark, small, unruly, odd, nothing):
    from reeflens.llm.decontamination import contaminated
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r.item_id, r.text) for r in items.collect()]
    docs, rows = small
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in contaminated(docs, items).collect()}
    assert got == brute.contained(rows, listed)
    odd_items = odd.selectExpr("doc_id item_id", "text", "id", "key")
    every = [(r.doc_id, r.text) for r in unruly.select("doc_id", "text").collect()]
    wanted = [(r.item_id, r.text) for r in odd_items.collect()]
    got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in contaminated(unruly, odd_items).collect()}
    assert got == brute.contained(every, wanted)
    assert contaminated(nothing, items).count() == 0 and contaminated(docs, odd_items.where("false")).count() == 0


def test_short_items_in_long_documents(spark):
    from reeflens.llm.decontamination import contaminated
    item = "quick brown foxes jump over lazy dogs near the old river bank today again"
    filler = " ".join(f"word{i}" for i in range(30000))
    docs = as_docs(spark, [(1, filler + " " + item + " " + filler, None, None), (2, filler, None, None),
                           (3, "Quick  BROWN\nfoxes jump over lazy dogs near the old river bank today again", None, None)])
    short = [(8, "word5 word6"), (9, None), (10, "WORD29999"), (11, "word6 word5"), (12, "again word0  word1\nword2"), (13, "over lazy dogs near"), (14, "9")]
    items = spark.createDataFrame([(7, item), *short], "item_id long, text string")
    exp = {(1, 7), (3, 7), (1, 8), (2, 8), (1, 10), (2, 10), (1, 12), (1, 13), (3, 13)}
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()} == exp
    # without long items nothing but the short runs is looked for
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, items.where("item_id <> 7")).collect()} == {x for x in exp if x[1] != 7}


def test_items_of_ten_shingles_are_not_missed(spark):
    """Eight of an item's ten shingles, in documents with as many shingles as bins."""
    from reeflens.llm.decontamination import contaminated
    from pyspark.sql import functions as F
    run = lambda n, k: F.concat_ws(" ", *[F.concat(F.lit(f"{k}{i}x"), F.col("id").cast("string")) for i in range(n)])
    ids = spark.range(20000)
    items = ids.select(F.col("id").alias("item_id"), run(14, "w").alias("text"))
    docs = ids.select(F.col("id").alias("doc_id"), F.concat_ws(" ", run(12, "w"), run(56, "f")).alias("text"))
    assert contaminated(docs, items).where("doc_id = item_id and n_shared = 8").count() == 20000


def test_token_counts_match_the_library(spark, small, unruly, nothing):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from reeflens.llm.token_counts import token_counts
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["", "<|startoftext|>a b<|endoftext|>", "İstanbul Σίσυφος ΟΔΟΣ", "it's I'LL we'd ''s don''t", "áb é K Å ﬁ ½ ² ª", None,
           "日本語 テスト", "x" * 5000, "a\x85b\xa0c\xadd\x1ce", "<|startoftext|", "Ǆ ŉ ſ ß ẞ a_b 1.5"]
    odd_df = as_docs(spark, [(i, t, None, None) for i, t in enumerate(odd)])
    for df in (odd_df, small[0], unruly):
        rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
        exp = [(d, len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for d, t in rows]
        assert sorted(map(tuple, token_counts(df, path).collect()), key=str) == sorted(exp, key=str)
    assert token_counts(nothing, path).count() == 0


def test_lines_of_any_length_are_chosen_alike(spark):
    """Near copies on both sides of 128 bytes, with letters of several bytes, periodic and without a sampled shingle."""
    import random

    from reeflens.llm.line_dedup import line_report
    rnd = random.Random(3)
    line = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n - 1)) + "z"
    rows = []
    for d in range(0, 80, 2):
        base = line(118 + d % 16)
        rows += [(d, base, None, None), (d + 1, base + line(8), None, None)]
    rows += [(100, "ab" * 60, None, None), (101, "ab" * 70, None, None), (102, "ba" * 64, None, None), (103, "x" * 400, None, None),
             (104, "x" * 12, None, None), (105, "abc" * 42 + "ab", None, None), (106, "abc" * 43, None, None)]
    for d in range(110, 120, 2):
        base = line(60)
        rows += [(d, base, None, None), (d + 1, base + "\U0001F41F\U0001F420\U0001F421\U0001F422\U0001F423\U0001F424\U0001F425\U0001F426", None, None)]
    got = {(r.doc_id, no) for r in line_report(as_docs(spark, rows)).collect() for no in r.removed}
    exp = brute.removed_lines(pairs(rows))
    assert len(exp) >= 48 and got == exp


def test_lines_near_the_threshold_are_found(spark):
    """Twelve bands find 0.99 of the pairs at Jaccard 0.8, six 0.95."""
    import random

    from reeflens.llm.line_dedup import line_report
    rnd, rows = random.Random(8), []
    line = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    for d in range(0, 1200, 2):
        base = line(87)  # 80 shingles, all of them in the 100 of the longer line
        rows += [(d, base, None, None), (d + 1, base + line(20), None, None)]
    found = sum(r.n_removed for r in line_report(as_docs(spark, rows)).collect())
    assert 0.975 * 600 <= found <= 600


@pytest.mark.parametrize("size", [65, 260, 1000])
def test_large_groups_of_like_documents(spark, size):
    """Groups above and far above the size up to which members of a bucket are compared pair by pair."""
    import random

    from reeflens.llm.near_dedup import near_duplicates
    rnd = random.Random(size)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(size):  # each has some of twenty words changed: many pairs near the threshold, many below
        own = list(words)
        for k in rnd.sample(range(120), rnd.randint(0, 9)):
            own[k] = f"v{k}x{rnd.randint(0, 2)}"
        rows.append((i, " ".join(own)))
    exp = brute.near(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(as_docs(spark, [(d, t, None, None) for d, t in rows])).collect()}
    assert got == exp


def test_sieve_keeps_every_key(spark, monkeypatch):
    from pyspark.sql import functions as F

    from reeflens.llm import scratch
    df = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("_bits2"))
    keys = df.where("k % 40 = 3").select("k")
    for bits, most in ((1 << 24, 520), (1 << 17, 700), (64, 20_000)):
        monkeypatch.setattr(scratch, "SIEVE_BITS", bits)
        out = scratch.sieved(df, keys, "k")
        assert out.columns == df.columns and out.join(keys, "k", "left_semi").count() == 500 <= out.count() <= most
    assert scratch.sieved(df, keys.where("false"), "k").count() == 0


def test_lines_of_one_name_stay_apart(small, odd, odd_rows, monkeypatch):
    """Lines that share 40 names at first, some of which clash again under their new ones, are still told apart."""
    from pyspark.sql import functions as F

    from reeflens.llm import line_dedup

    def narrow(salt=0):
        names = F.xxhash64("h1", "h2", F.lit(salt))
        names = F.pmod(names, F.lit(40 if not salt else 20000)) if salt < 2 else names
        return F.when(F.col("h1").isNotNull(), names)

    monkeypatch.setattr(line_dedup, "_name", narrow)
    for df, rows in ((odd, pairs(odd_rows)), small):
        got = {(r.doc_id, no) for r in line_dedup.line_report(df).collect() for no in r.removed}
        assert got == brute.removed_lines(rows)


def test_odd_sketches_lose_no_pair_at_the_threshold(spark):
    """Sets of any size that reach the share pass; of those far below it few do while they are small."""
    import random

    from pyspark.sql import functions as F

    from reeflens.llm.rounds import _may_reach, odd_sketches
    rnd, sets = random.Random(3), {}
    for k in range(120):
        n = rnd.choice([1, 2, 9, 45, 300, 3000])
        x = [rnd.getrandbits(63) - (1 << 62) for _ in range(n)]
        gone = rnd.choice([0, n // 9, n // 4, n // 2])
        sets[2 * k], sets[2 * k + 1] = set(x), set(x[gone:]) | {rnd.getrandbits(62) for _ in range(gone)}
    rows = spark.createDataFrame([(k, s) for k, v in sets.items() for s in v], "node long, shingle long")
    sketched = odd_sketches(rows).join(rows.groupBy("node").agg(F.count("*").alias("n")), "node")
    both = sketched.alias("x").join(sketched.alias("y"), F.expr("x.node % 2 = 0 and y.node = x.node + 1"))
    passed = {r[0] for r in both.where(_may_reach("x", "y", 80)).select("x.node").collect()}
    for k in range(0, 240, 2):
        a, b = sets[k], sets[k + 1]
        share = len(a & b) / len(a | b)
        assert k in passed or share < 0.8
        assert k not in passed or share > 0.5 or len(a) > 1000


def test_rare_pairs_come_from_owners_of_shingles(spark):
    """Owners of many rare shingles are paired once: no rows of a shingle meet in a join."""
    import random

    from reeflens.llm.rounds import _cores
    rnd, sets = random.Random(4), {}
    for node in range(1000):
        groups = {node // 3, 400 + node // 7} if node % 5 else {node // 3}
        sets[node] = {10 * g + k for g in groups for k in range(8)} | {-1, -2}
    parts = {n: rnd.choice([0, n // 3 * 3, n]) for n in sets}
    listed = spark.createDataFrame([(n, 0, s) for n, v in sets.items() for s in v], "node long, cluster long, shingle long")
    clusters = spark.createDataFrame([(n, 0) for n in sets], "node long, cluster long")
    sizes = spark.createDataFrame([(n, len(v)) for n, v in sets.items()], "node long, n long")
    placed = spark.createDataFrame([(n, 0, p) for n, p in parts.items()], "node long, cluster long, part long")
    _, pairs, _ = _cores(clusters, sizes, listed, placed, 3)
    owners = {}
    for n, v in sets.items():
        for s in v:
            owners.setdefault(s, []).append(n)
    exp = {(a, b) for of in owners.values() if len(of) <= 3 for a in of for b in of if a < b and parts[a] != parts[b]}
    assert exp and sorted(map(tuple, pairs.select("a", "b").collect())) == sorted(exp)
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # that of the parts


@pytest.mark.parametrize("rare_in", [3, 8])
def test_owners_of_rare_shingles_without_a_join(spark, monkeypatch, rare_in):
    """Up to three owners come from the counts; the shingles of all nodes are joined with nothing for them."""
    import random
    import re
    from collections import Counter

    from reeflens.llm import rounds
    rnd, plans, write = random.Random(9), [], rounds.stored
    owners = {s: rnd.sample(range(-300, 300), rnd.choice([1, 1, 2, 3, 4, 6, 8, 9, 30])) for s in range(900)}
    cluster, part = {n: n % 2 if n < 40 else 5 for n in range(-300, 300)}, {n: n // 4 for n in range(-300, 300)}
    listed = spark.createDataFrame([(n, cluster[n], s) for s, of in owners.items() for n in of], "node long, cluster long, shingle long")
    clusters = spark.createDataFrame(list(cluster.items()), "node long, cluster long")
    sizes = spark.createDataFrame([(n, 1000) for n in cluster], "node long, n long")
    parts = spark.createDataFrame([(n, cluster[n], p) for n, p in part.items()], "node long, cluster long, part long")
    monkeypatch.setattr(rounds, "stored", lambda df, name: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, name))[1])
    bound, pairs, _ = rounds._cores(clusters, sizes, listed, parts, rare_in)
    of_cluster, members = {}, Counter(cluster.values())
    for s, of in owners.items():
        for n in of:
            of_cluster.setdefault((cluster[n], s), []).append(n)
    rare = [of for (c, _), of in of_cluster.items() if len(of) <= min(rare_in, 1 + members[c] // 50)]
    core = Counter(n for of in rare for n in of)
    assert {r.node: r.core for r in bound.collect()} == {n: 1000 - core[n] for n in cluster}
    exp = {(a, b) for of in rare for a in of for b in of if a < b and part[a] != part[b]}
    assert exp and sorted(map(tuple, pairs.select("a", "b").collect())) == sorted(exp)
    assert plans and (rare_in > 3 or not any(re.search("Join.*shingle", p) for p in plans))


@pytest.mark.parametrize("some", [0, 10_000])
def test_last_pairs_are_verified_in_one_step_or_two(spark, monkeypatch, some):
    """Few pairs are verified at once, without a step before; the lines that go are those of brute force."""
    import random

    import brute

    from reeflens.llm import line_dedup, rounds
    rnd, steps, write = random.Random(3), [], rounds.stored
    bases = [[rnd.choice("abcdefghijklmnop") for _ in range(120)] for _ in range(3)]
    rows = []
    for i in range(260):
        line = list(bases[i % 3])
        for _ in range(rnd.randrange(4)):
            line[rnd.randrange(len(line))] = rnd.choice("qrstuvw")
        rows.append((i, "".join(line)))
    monkeypatch.setattr(rounds, "SOME", some)
    monkeypatch.setattr(rounds, "stored", lambda df, name: (steps.append(name), write(df, name))[1])
    df = as_docs(spark, [(d, t, None, None) for d, t in rows])
    got = {(r.doc_id, no) for r in line_dedup.line_report(df).collect() for no in r.removed}
    assert got == brute.removed_lines(rows)
    assert ("ahead" in steps) == (some == 0)


def test_stored_tables_leave_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    from reeflens.llm.scratch import CLEANUP, stored, stored_by
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    before, setting = files(), spark.conf.get(CLEANUP, "false")
    for write in (lambda df: stored(df, "t"), lambda df: stored_by(df, "t", "k")):
        out = write(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("c")))
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.2)
        assert not files() - before
        assert out.count() == 700 and spark.conf.get(CLEANUP, "false") == setting


def test_lines_on_both_sides_of_the_long_ones(spark):
    """Lines below and above LONG shingles are compared, with one another too."""
    import random

    from reeflens.llm.line_dedup import LONG, line_report
    rnd, rows = random.Random(6), []
    line = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n - 1)) + "z"
    for d in range(0, 24, 2):
        base = line(LONG - 20 + 4 * d)
        rows += [(d, base, None, None), (d + 1, base + line(30), None, None)]
    rows += [(100, line(2000), None, None), (101, rows[0][1] + line(400), None, None)]
    got = {(r.doc_id, no) for r in line_report(as_docs(spark, rows)).collect() for no in r.removed}
    assert got == brute.removed_lines(pairs(rows)) and len(got) == 12


def test_signature_rows_hold_every_shingle_of_a_line(spark):
    """Several shingles a row, none left out, whatever the line's length and its characters' bytes."""
    from reeflens.llm.line_dedup import STEP, WIDTH, _hashes
    lines = ["x" * n for n in range(1, 3)] + ["".join(chr(97 + (i * i // 3) % 26) for i in range(n)) for n in range(3, 40)]
    lines += ["\U0001F41Fé" * 15, "ab" * 30, "d\u00e9j\u00e0 vu " * 9]
    df = spark.createDataFrame(list(enumerate(lines)), "node long, x string")
    got = {}
    for row in _hashes(df).collect():
        got.setdefault(row.node, []).append(row[1:])
    for node, x in enumerate(lines):
        sets = {x[i:i + WIDTH] for i in range(max(1, len(x) - WIDTH + 1))}
        assert len(set().union(*got[node])) == len(sets)
        assert len(got[node]) == -(-max(1, len(x) - WIDTH + 1) // STEP)


def test_shingles_are_hashed_as_they_are_cut(spark):
    """As many hashes as a line has shingles, alike for like shingles of different lines."""
    from reeflens.llm.line_dedup import WIDTH, _shingles
    lines = ["", "x", "abc", "x" * 8, "ab" * 40, "\U0001F41Fé" * 15, "déjà vu " * 9, "".join(chr(97 + (i * i // 3) % 26) for i in range(300))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "node long, x string")
    assert dict(df.select(_shingles("x").alias("s")).dtypes) == {"s": "array<bigint>"}
    cut = {x: [x[i:i + WIDTH] for i in range(max(1, len(x) - WIDTH + 1))] for x in lines}
    hashed = {lines[r.node]: r.s for r in df.select("node", _shingles("x").alias("s")).collect()}
    names = dict(zip(sum(cut.values(), []), sum((hashed[x] for x in cut), [])))
    assert len(set(names.values())) == len(names)
    assert all(hashed[x] == [names[s] for s in found] for x, found in cut.items())


def test_buckets_of_two_are_not_compared_again(spark):
    """The only pair of such a bucket has been tried as leader and member; larger open ones come back whole."""
    from reeflens.llm.rounds import _placed
    buckets = {1: [1, 2], 2: [1, 2, 3], 3: [4, 5], 4: [4, 5, 6], 5: [7, 8, 9]}
    shared = spark.createDataFrame([(k, n, min(of)) for k, of in buckets.items() for n in of], "key long, node long, leader long")
    labels = spark.createDataFrame([(4, 4), (5, 4), (7, 7), (8, 7), (9, 7)], "node long, component long")
    got = {}
    for r in _placed(shared, labels).collect():
        got.setdefault((r.key, r.c), []).append((r.node, r.part))
    assert {k: sorted(v) for k, v in got.items()} == {(2, 3): [(1, 1), (2, 2), (3, 3)], (4, 3): [(4, 4), (5, 4), (6, 6)]}


def test_members_are_dealt_by_key_once(spark):
    """Leaders and buckets read one exchange of the members; the buckets are those of the two nodes or more."""
    from reeflens.llm.rounds import shared_buckets
    buckets = {1: [5], 2: [-3, 4, 9], 3: [7, 8], 4: [1]}
    members = spark.createDataFrame([(k, n) for k, of in buckets.items() for n in of], "key long, node long")
    found = shared_buckets(members.repartition("key"))
    assert sorted(map(tuple, found.collect())) == sorted((k, n, min(of)) for k, of in buckets.items() if len(of) > 1 for n in of)
    assert "ENSURE_REQUIREMENTS" not in found._jdf.queryExecution().executedPlan().toString()


def test_odd_sketches_of_lines_are_those_of_their_distinct_shingles(spark):
    """Several shingles a row, repeats counted once, whatever is left for the last row."""
    from pyspark.sql import functions as F

    from reeflens.llm.line_dedup import _odd_sketches, _shingles
    from reeflens.llm.rounds import odd_sketches
    lines = ["x", "x" * 50, "ab" * 30, "d\u00e9j\u00e0 vu " * 9, "\U0001F41F\u00e9" * 15]
    lines += ["".join(chr(97 + (i * i // 3) % 26) for i in range(n)) for n in range(8, 24)] + ["".join(chr(97 + (i * i * 7 // 5) % 23) for i in range(900))]
    df = spark.createDataFrame(list(enumerate(lines)), "node long, x string")
    got = {r.node: r for r in _odd_sketches(df).collect()}
    each = df.select("node", F.explode(F.array_distinct(_shingles("x"))).alias("shingle"))
    for r in odd_sketches(each).collect():
        x, line = got[r.node], lines[r.node]
        assert x.n == len({line[i:i + 8] for i in range(max(1, len(line) - 7))})
        assert all(x[c] == r[c] for c in r.asDict())
    assert len(got) == len(lines)


def test_a_word_is_told_as_by_the_pattern(spark):
    from reeflens.llm.sqltext import WORD, has_word
    texts = [None, "", " ", " \t\n\x0b\f\r", "\r a", "\u00a0", "\u2003 ", "\x1f", "\x85", "\u0130", "x ", "\U0001F41F", "\x00", "\x08"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    assert all(r.a == r.b for r in rows.select(has_word("t").alias("a"), rows.t.rlike(WORD).alias("b")).collect())


def test_a_sieve_grows_with_its_keys(spark, monkeypatch):
    """Of the rows that are not wanted, few stay, for many keys too; none that is wanted goes."""
    from reeflens.llm import scratch
    monkeypatch.setattr(scratch, "SIEVE_BITS", 1 << 10)
    keys = spark.range(0, 9000, 3).withColumnRenamed("id", "k")
    left = {r.k for r in scratch.sieved(spark.range(9000).withColumnRenamed("id", "k"), keys, "k").collect()}
    assert left >= set(range(0, 9000, 3)) and len(left) < 3600
