"""Quality rules and mixing against SQL, models by held-out accuracy, pages by cases, the pipeline by its stages."""

import sys
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parents[2] / "tools"))
SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(odd, tmp_path_factory):
    """The odd documents as a folder of tables, for queries and SQL."""
    path = tmp_path_factory.mktemp("tables")
    odd.toPandas().to_parquet(path / "documents.parquet")
    odd.selectExpr("doc_id item_id", "text").where("doc_id in (7, 9)").toPandas().to_parquet(path / "benchmark.parquet")
    return str(path)


@pytest.mark.parametrize("where", ["odd", SMALL])
def test_queries_match_their_sql(spark, folder, where):
    from compare import compare_one, duck

    from reeflens.llm.queries import QUERIES, SQL
    sf = folder if where == "odd" else where
    con = duck(sf)
    for name, sql in SQL.items():
        ok, said = compare_one(spark, con, name, sf, QUERIES[name], sql)
        assert ok, said


def test_rules_and_mix_take_unruly_rows(unruly, nothing):
    from reeflens.llm.mixing import mix_sources
    from reeflens.llm.quality_rules import quality
    n = unruly.count()
    rules = quality(unruly).collect()
    assert len(rules) == n and quality(nothing).count() == 0
    assert all(r.base_failed and not r.kept for r in rules if r.doc_id in (4, 5, 6))
    mixed = mix_sources(unruly)
    rows = mixed.collect()
    assert len(rows) == n and mix_sources(nothing).count() == 0 and len(set(mixed.columns)) == len(mixed.columns)
    assert all(0 <= r.copies <= 3 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mix_sources(unruly).collect()))


def test_frequent_lines_deplete_documents(spark):
    from conftest import as_docs

    from reeflens.llm.quality_rules import MAX_DOCS, quality
    own = lambda d: " ".join(f"own{d}x{i}" for i in range(60))
    line = " ".join(f"menu{i}" for i in range(55))
    rows = [(d, f"{line}\n{own(d)}" if d % 2 else f"{line} \n{own(d)[:200]}", None, "host") for d in range(MAX_DOCS + 2)]
    rows += [(1000 + d, line.upper() + "\nshort", None, "other") for d in range(MAX_DOCS)]
    got = {r.doc_id: r for r in quality(as_docs(spark, rows)).collect()}
    assert all(got[d].kept == bool(d % 2) and got[d].n_removed_words == 55 for d in range(MAX_DOCS + 2))
    assert all(got[1000 + d].kept and got[1000 + d].n_removed_words == 0 for d in range(MAX_DOCS))


def test_toxicity_on_held_out_labels(spark, unruly, nothing):
    from reeflens.llm.toxicity import fit, score
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = fit(docs, labels)
    rows = score(docs, model).join(labels, "doc_id").where("held_out").collect()
    bad, good = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad]) > 0.9
    again = fit(docs, labels)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias
    out = score(unruly, model).collect()
    assert len(out) == unruly.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert score(nothing, model).count() == 0
    assert all(r.predicted == 0 for r in score(unruly, fit(nothing, labels.where("false"))).collect())


def test_language_on_held_out_texts(spark, unruly, nothing):
    from reeflens.llm.language_id import fit, keep_known, predict
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(docs)
    rows = predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    out = predict(unruly, model).collect()
    assert len(out) == unruly.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (4, 5, 6))
    assert all(r.lang_pred in model["langs"] for r in out if r.doc_id in (9, 10, 12))
    kept = keep_known(unruly, model)
    assert kept.columns == unruly.columns and not {4, 5, 6} & {r.doc_id for r in kept.collect()}
    assert predict(nothing, model).count() == 0 and keep_known(nothing, model).count() == 0
    assert {r.lang_pred for r in predict(unruly, fit(nothing)).collect()} == {"und"}


def test_language_machines_are_fitted_in_a_task(spark, odd, nothing, monkeypatch):
    """The driver holds the machines, not the sample; reruns give the same ones."""
    import os

    from reeflens.llm import language_id
    driver, hold = os.getpid(), language_id.Rows

    def rows(parts):
        assert os.getpid() != driver
        return hold(parts)

    monkeypatch.setattr(language_id, "Rows", rows)
    one, two = language_id.fit(odd), language_id.fit(odd)
    assert one["langs"] and one["langs"] == two["langs"] and one["machines"] == two["machines"]
    assert (one["weights"] == two["weights"]).all()
    assert language_id.fit(nothing)["langs"] == []


PAGE = "<p>" + "plain words that make up an article about reefs and more. " * 5 + "</p>"
CASES = [
    ("", ""), ("   ", ""), ("just text", "just text"),
    ("<article><h1>A &lt;b&gt; &#233;&nbsp;x</h1><p>1 < 2\n and  3</p></article>", "A <b> é x\n1 < 2 and 3"),
    ("<body><nav><p>no</p></nav><article><p><b>open<br><p>next</p></article><footer>no</footer>", "open\nnext"),
    ("<main><header><h1>H</h1></header><p>yes<!-- <p>no</p> --> ok</p><aside>no</aside><form><input>no</form></main>", "H\nyes ok"),
    ("<article><script>if(a<b){'</p>'}</script><p>yes</p><style>x</style></article>", "yes"),
    ("<article><p>text</p></article><div id='comments'><p>" + "nice post " * 90 + "</p></div>", "text"),
    (f"<body><div><a href=1>l1</a> <a>l2</a></div><div><h2>T</h2>{PAGE}{PAGE}</div><div class='cookie-notice'>c</div>",
     "T\n" + "\n".join([" ".join(PAGE[3:-4].split())] * 2)),
    ("<div hidden>no</div><ul><li>one<li>two</ul>", "one\ntwo"),
    # noise whose end tag is left out, or ended by that of an outer element
    ('<ul><li class="menu-item">A<li class="menu-item">B</ul><article><p>yes</p></article>', "yes"),
    ('<p class="notice">x<article><p>yes</p></article>', "yes"),
    ('<dl><dt>a<dd class="ad">no<p>no<dd>yes</dl>', "a\nyes"),
    ('<table><tr class="ad"><td>no<tr><td>yes<td class="ad">no<td>too<tbody><tr><td>more</table>', "yes\ntoo\nmore"),
    ("<main><div><aside>no<p>no</div><p>yes<a href=1><nav><div>no</a></div>no</nav></main>", "yes"),
    ("<main><p>a<button><div>no</div></button>b</p><table><tr><td><nav>no</div></nav>c</table></main>", "ab\nc"),
    # a form around the page, with other forms in it
    (f"<body><form id=aspnetForm><nav>no</nav><div>{PAGE}{PAGE}</div><form>no<label>no</label></form></form>",
     "\n".join([" ".join(PAGE[3:-4].split())] * 2)),
    (f"<form><article>{PAGE}</article></form><div>" + "<a href=1>no no</a> " * 300 + "</div>", " ".join(PAGE[3:-4].split())),
]


def test_main_text_of_pages(spark):
    from reeflens.llm.html_density import extract_text, main_text
    for html, text in CASES:
        assert main_text(html) == text, html
    assert main_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(CASES)] + [(None, None, None, "x"), (0, "u0", None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_text(df).collect()
    assert sorted((r.text, r.n_chars) for r in out) == sorted([(t, len(t)) for _, t in CASES] + [("", 0)] * 2)
    assert extract_text(df.where("false")).count() == 0


def _words(rng, n):
    return " ".join(rng.choice(["reef", "coral", "survey", "of", "a", "transect"]) for _ in range(n))


def _paragraphs(rng, n, linked=False):
    """n paragraphs of 30 to 80 words, and their texts; every second one with a short link if asked."""
    texts = [_words(rng, rng.randint(30, 80)) for _ in range(n)]
    tags = [f"<p>{t}</p>" if not linked or k % 2 else f"<p>{t} <a href='x'>see here</a></p>" for k, t in enumerate(texts)]
    return "".join(tags), [t if not linked or k % 2 else f"{t} see here" for k, t in enumerate(texts)]


def test_main_text_by_density_alone():
    """Pages without article and main elements: teasers with a link each, link lists, links in the article."""
    import random

    from reeflens.llm.html_density import main_text
    rng = random.Random(5)
    for linked in (False, True):
        for n in (0, 3, 12, 60):
            teasers = "<ul>" + "".join(f"<li><a href='t'>{_words(rng, 5)}</a> {_words(rng, 9)}</li>" for _ in range(n)) + "</ul>"
            names = "<div>" + "".join(f"<a href='n'>{_words(rng, 2)}</a> " for _ in range(n)) + "</div>"
            body, texts = _paragraphs(rng, 6, linked)
            page = f"<body><div>{names}</div><h1>Title</h1><div>{body}</div><h3>More</h3><div>{teasers}</div></body>"
            assert main_text(page) == "\n".join(["Title", *texts]), (linked, n)
    # an article in two parts: both are over the threshold of the body's path
    one, first = _paragraphs(rng, 5)
    two, second = _paragraphs(rng, 4)
    aside = "".join(f"<li><a href='t'>{_words(rng, 5)}</a> {_words(rng, 3)}</li>" for _ in range(30))
    for outer in ("div", "main"):
        page = f"<body><{outer}><div>{one}</div><ul>{aside}</ul><div>{two}</div></{outer}></body>"
        assert main_text(page) == "\n".join(first + second)
    # one short paragraph in an article element, beside teasers in no element of that kind
    assert main_text(f"<body><article><p>{first[0]}</p></article><div><ul>{aside}</ul></div></body>") == first[0]


def test_main_text_like_the_plain_density():
    import random

    from reeflens.llm.html_density import main_text
    rng = random.Random(11)

    def inline():
        text = _words(rng, rng.randint(1, 30))
        return text if rng.random() < 0.6 else f"{text} <a href='x'>{_words(rng, rng.randint(1, 6))}</a> {_words(rng, 2)}"

    def block(depth):
        kind = rng.random()
        if kind < 0.45 or not depth:
            return f"<p>{inline()}</p>"
        if kind < 0.55:
            tag = rng.choice(["h1", "h2", "h3"])
            return f"<{tag}>{_words(rng, 3)}</{tag}>"
        if kind < 0.7:
            return "<ul>" + "".join(f"<li>{inline()}</li>" for _ in range(rng.randint(1, 9))) + "</ul>"
        tag = rng.choice(["div", "section"])
        return f"<{tag}>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 6))) + f"</{tag}>"

    differ = set()
    for _ in range(400):
        page = "<body>" + "".join(block(3) for _ in range(rng.randint(1, 6))) + "</body>"
        text = main_text(page)
        assert text == brute.dense_text(page), page
        differ.add(len(text))
    assert len(differ) > 100


def test_main_text_of_the_pages_table(spark):
    """The pages hold their article in one element, so its blocks can be cut out plainly."""
    import html
    import re

    from reeflens.llm.queries import QUERIES
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op3_html_extraction"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pipeline_stages(spark):
    import corpus_pipeline

    from reeflens.llm.scratch import stored
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SMALL), name))
    assert all(t.columns == docs.columns for t in tables[:-1])
    got = [[tuple(r) for r in t.select("doc_id", "text").collect()] for t in tables]
    language, lines, near, clean, mix = got[1:]
    assert {d for d, _ in language} == {d for d, t in got[0] if t and any(c.isalpha() for c in t)}
    gone = brute.removed_lines(language)
    exp = {}
    for d, t in language:
        left = [x for no, x in enumerate(t.split("\n")) if (d, no) not in gone]
        if "\n".join(left) == t or brute.WORD.search("\n".join(left)):
            exp[d] = "\n".join(left)
    assert dict(lines) == exp
    alike = brute.near(lines, 5)
    assert sorted(near) == sorted((d, t) for d, t in lines if alike[d][1] == d)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = {d for d, _ in brute.contained(near, items)}
    assert sorted(clean) == sorted((d, t) for d, t in near if d not in hit)
    assert set(mix) <= set(clean) and max(r["copy"] for r in tables[-1].collect()) <= 3
    words = lambda rows: sum(len(brute.WORD.findall(t)) for _, t in rows)
    assert abs(words(mix) - words(clean)) < 0.15 * words(clean)
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(str, tables[-1].collect()))


def test_pipeline_compares_documents_by_five_words(spark):
    """Twelve changed words of 300 leave 0.85 of the pairs of words and 0.66 of the runs of five."""
    import corpus_pipeline
    from conftest import as_docs
    words = [f"w{i}" for i in range(300)]
    changed = [f"x{i}" if i % 25 == 12 else w for i, w in enumerate(words)]
    near = [f"x{i}" if i == 150 else w for i, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(changed)), (3, " ".join(near)), (4, "One two three"), (5, "one  TWO three"), (6, "one two")]
    docs = as_docs(spark, [(d, t, "en", "a") for d, t in rows])
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 6]
    assert {d for d, (_, c) in brute.near(rows).items() if d == c} == {1, 4, 6}  # two words are looser


def test_pipeline_takes_odd_rows(spark, unruly, folder):
    import corpus_pipeline

    from pyspark.sql import functions as F

    from reeflens.llm.scratch import stored
    docs = unruly.withColumn("copy", F.lit("own"))  # besides size, copies, score, kept and others
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], folder), name))
    assert all(t.columns == docs.columns for t in tables[:-1])
    assert sorted(tables[-1].columns) == sorted(docs.columns)
    ids = [Counter(r.doc_id for r in t.select("doc_id").collect()) for t in tables]
    before = ids[0]
    assert not {4, 5, 6} & set(ids[1]) and {1, 2, 3, 9, 10, 11, 12, 14} <= set(ids[1]) and ids[1][None] == 1 and ids[1][1] == before[1]
    for a, b in zip(ids[:4], ids[1:5]):
        assert not b - a  # no stage before the mix adds a row
    assert len([d for d in (1, 2, 3) if d in ids[3]]) == 1  # copies and a near copy
    assert not {7, 9} & set(ids[4])  # the benchmark of the fixture holds their texts
    final = tables[-1].collect()
    assert final and all(r["size"] == r["copies"] == r["score"] == "x" and 1 <= r["copy"] <= 3 for r in final)
    assert set(ids[5]) <= set(ids[4])


def test_pipeline_takes_empty_tables(spark, nothing, folder):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, folder)
        assert out.count() == 0 and set(nothing.columns) <= set(out.columns)
