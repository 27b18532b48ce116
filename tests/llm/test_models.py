"""Language models, embedding links and page texts."""

import math
import random
from html.parser import HTMLParser
from collections import Counter

import numpy as np
import pytest

from sessionloom.llm import kneser_ney, multi_index, page_diff

from . import corpus


# --- language models ---------------------------------------------------------


def naive_kneser_ney(texts, order=kneser_ney.ORDER):
    """Interpolated probabilities of one language by the textbook recursion."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for text in texts:
        s = " " * (order - 1) + text
        for i in range(order - 1, len(s)):
            counts[order][s[i - order + 1 : i + 1]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])

    def probability(gram):
        n = len(gram)
        n1, n2 = (sum(1 for v in counts[n].values() if v == k) for k in (1, 2))
        d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 else 0.5
        inside = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        lower = probability(gram[1:]) if n > 1 else 1 / (len(counts[1]) + 1)
        if not inside:
            return lower
        total = sum(inside.values())
        return max(counts[n].get(gram, 0) - d, 0) / total + d * len(inside) / total * lower

    return probability


def test_probabilities_are_kneser_neys():
    texts = {"x": ["abab abc", "bab cab"], "y": ["xyzzy xy", "yzx abz"]}
    streams = {k: [kneser_ney.symbol_stream([t])[0] for t in v] for k, v in texts.items()}
    grams = np.unique(np.concatenate([g for v in streams.values() for g in v]))
    counts = np.stack([[sum((g == own).sum() for own in v) for g in grams] for v in streams.values()], 1)
    model = kneser_ney.build_model(["x", "y"], grams, counts)
    tested = ["abab", "   a", "xyzz", "zzzz", "c ab", "qabc", "  xy"]
    packed = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(g)) for g in tested], np.uint64)
    found = model.log_probability(packed)
    for k, lang in enumerate(texts):
        p = naive_kneser_ney(texts[lang])
        for i, gram in enumerate(tested):
            assert found[i, k] == pytest.approx(math.log(p(gram)), abs=1e-4), (lang, gram)


def test_symbols_of_awkward_texts():
    grams, limits = kneser_ney.symbol_stream([None, "", "12 !", "Ab--c", "a\0b", "İ"])
    assert np.diff(limits).tolist()[:3] == [0, 0, 0]
    assert np.diff(limits)[3] == len("ab c") and np.diff(limits)[4] == len("a b")
    assert len(grams) == limits[-1]


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[: -len('0.001')]}0.01/documents.parquet")
    model = kneser_ney.fit(docs.where("doc_id % 4 <> 2"))
    found = kneser_ney.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 4 = 2").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()
    small = kneser_ney.fit(docs.where("doc_id % 4 <> 2"), max_cells=8000)
    assert len(small.grams[-1]) * len(small.langs) <= 8000
    foreign = spark.createDataFrame([(1, "съешь же ещё этих мягких булок"), (2, "the and of with from this that are is")], "doc_id long, text string")
    judged = kneser_ney.with_rejection(kneser_ney.predict(docs.select("doc_id", "text").unionByName(foreign), model)).toPandas()
    assert judged[judged.doc_id < 1000].rejected.mean() < 0.02
    assert judged.sort_values("entropy").tail(1).rejected.item()


def test_no_ngram_is_dropped(spark):
    """Entropies are those of all counts, however few n-grams are held in memory."""
    rng = random.Random(5)
    rows = [(k, " ".join(corpus.prose(rng, 40)), "hot") for k in range(40)]
    rows += [(100 + k, "żółw gęś " + " ".join(corpus.prose(rng, 3)), "small") for k in range(3)] + [(200, "漢字 źdźbło", "tiny"), (201, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counted = kneser_ney.gram_counts(docs).collect()
    langs = sorted({r.lang for r in counted})
    keys = np.unique(np.array([r.gram for r in counted]).view(np.uint64))
    table = np.zeros((len(keys), len(langs)))
    for r in counted:
        table[np.searchsorted(keys, np.uint64(r.gram % 2**64)), langs.index(r.lang)] = r.n
    whole = kneser_ney.build_model(langs, keys, table)
    tested = [*rows, (300, "nie widziane: qqq жук źdźbło", None)]
    expected, _ = whole.cross_entropy([r[1] for r in tested])
    more = spark.createDataFrame(tested, "doc_id long, text string, lang string")
    for cells in (0, 300):
        model = kneser_ney.fit(docs, max_cells=cells)
        assert model.langs == langs and len(model.grams[-1]) * len(langs) <= cells
        found = {r.doc_id: r for r in kneser_ney.predict(more, model).collect()}
        assert len(found) == len(tested)
        for r, entropy in zip(tested, expected):
            if r[1]:
                assert found[r[0]].entropy == pytest.approx(entropy.min(), abs=1e-5)
                assert found[r[0]].lang_pred == langs[entropy.argmin()]


def test_awkward_predictions(odd_docs, no_docs, rows):
    model = kneser_ney.fit(odd_docs)
    found = kneser_ney.predict(odd_docs, model).collect()
    assert len(found) == odd_docs.count()
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        if r.doc_id is not None:
            lettered = any(map(str.isalpha, texts[r.doc_id] or ""))
            assert (r.lang_pred == "und") == (not lettered) and (r.score > 0) == lettered
    assert kneser_ney.fit(no_docs) is None
    assert {r.lang_pred for r in kneser_ney.predict(odd_docs, None).collect()} == {"und"}


# --- embeddings --------------------------------------------------------------


def test_multi_sequence_visits_in_order():
    rng = np.random.default_rng(0)
    first, second = rng.random(7), rng.random(5)
    order = sorted(range(35), key=lambda k: first[k // 5] + second[k % 5])
    assert multi_index.multi_sequence(first, second, 35) == order
    assert multi_index.multi_sequence(first, second, 9) == order[:9]


def vectors(n=400, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(60, dim))
    out = [(i, (centres[rng.integers(60)] + 0.12 * rng.normal(size=dim)).tolist(), i % 3) for i in range(n)]
    dense = rng.normal(size=dim)
    out += [(n + i, (dense + 0.02 * rng.normal(size=dim)).tolist(), 1) for i in range(150)]
    k = len(out)
    out += [(k + i, out[5][1], 2) for i in range(5)]
    out += [(k + 5, None, 0), (k + 6, [0.0] * dim, 0), (k + 7, [float("nan")] * dim, 0), (k + 8, [1.0, None] * (dim // 2), None)]
    out += [(k + 9, [float("inf")] + [1.0] * (dim - 1), 0), (k + 10, [], 0), (k + 11, [1e-30 * x for x in out[7][1]], 0), (k + 12, [1.0, 2.0, 3.0], 0)]
    out += [(k + 13, [1.0, 2.0, 3.0001], 0), (k + 14, [2.5], 0)]
    return out


def expected_links(rows, similarity):
    def sound(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = {i: np.array(v) / np.abs(v).max() for i, v, _ in rows if sound(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) > 1 and unit[a] @ unit[b] >= similarity]
    return links


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links(spark, block, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rows = vectors()
    links = expected_links(rows, 0.95)
    degree = Counter(x for link in links for x in link)
    component = corpus.components([r[0] for r in rows], links)
    table = spark.createDataFrame([*rows, rows[3], (None, rows[3][1], 5)], "vec_id long, embedding array<double>, label int")
    found = multi_index.near_duplicates(table).collect()
    assert len(found) == len(rows) + 2
    named = {r.vec_id: r for r in found if r.vec_id is not None}
    missed = sum(degree[i] - named[i].n_links for i in named)
    assert all(named[i].n_links <= degree[i] for i in named) and missed <= 0.02 * 2 * len(links)
    if not missed:
        assert all(named[i].component_id == component[i] and named[i].kept == (component[i] == i) for i in named)
    assert len(links) > 10_000


@pytest.mark.parametrize("clusters", [0, 10])
def test_rare_links_are_found(spark, clusters):
    """Few near copies, all just above the limit, among vectors without links."""
    rng = np.random.default_rng(clusters)
    n, dim, pairs = 12_000, 32, 60
    x = rng.normal(size=(n, dim))
    if clusters:
        x += 1.2 * rng.normal(size=(clusters, dim))[rng.integers(clusters, size=n)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(pairs):
        away = rng.normal(size=dim)
        away -= (away @ x[k]) * x[k]
        angle = rng.uniform(0.9502, 0.955)
        x[n - 1 - k] = angle * x[k] + np.sqrt(1 - angle**2) * away / np.linalg.norm(away)
    expected = np.argwhere(np.triu(x @ x.T >= 0.95, 1))
    assert pairs <= len(expected) < 3 * pairs
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in multi_index.near_duplicates(table).where("n_links > 0").collect()}
    assert set(found) <= set(expected.ravel().tolist())
    assert sum(found.values()) >= 0.95 * 2 * len(expected)


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert multi_index.near_duplicates(empty).count() == 0
    single = spark.createDataFrame([(4, [1.0, 0.5])], "vec_id long, embedding array<float>")
    assert multi_index.near_duplicates(single).collect()[0][1:] == (0, 4, True)


# --- pages -------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="ad">Buy<p>now</div><!-- <p>no</p> --><article><h2>Head &lt;b&gt; &eacute;&#233;</h2>
<p>One <b>two</b>\n  three&nbsp;four<br>five<aside>side</aside><p title="a > b">six<form><input>f</form>
<ul><li>seven<li>eight</ul><section class="comments"><article>rude</article></section></article><p>after<footer>&copy; F</footer></body></html>"""


def test_blocks():
    inside = [t for t, main in page_diff.blocks(PAGE) if main]
    assert inside == ["Head <b> éé", "One two three four five", "six", "seven", "eight"]
    assert page_diff.blocks("") == [] and page_diff.blocks("<p>a<scr") == [("a", False)]
    assert page_diff.blocks("1 < 2 &am <p/>x<script>never closed") == [("1 < 2 &am", False), ("x", False)]
    assert page_diff.blocks("<div class=ad>open<article><p>text</article>") == [("text", True)]


@pytest.mark.parametrize(
    "html, text",
    [
        # Reader comments are articles too, inside and beside the page's own.
        ("<article><p>Own words here<article class=comment>rude</article><p>more</article><article id='comment-12'>x</article>", "Own words here\nmore"),
        ("<article><p>Own words<section class='commentList'><p>a</section><div itemprop=comment>b</div></article>", "Own words"),
        # Words that tell something only by themselves.
        ("<article><p>A<p class='notice-period'>B<p class='share price'>C<div class='share'>D</div></article>", "A\nB\nC"),
        ("<article><p>A<div class='leaderboardAd'>B</div><div class='ad-300 left'>C</div><ul class='share-buttons'><li>D</ul></article>", "A"),
        ("<div class='no-sidebar'><p>A<div class='cookie-notice bottom'>B</div></div>", "A"),
        # A teaser doesn't hide the page, and what stands between two articles stays.
        ("<p>A long text of the page itself, with all its words.<article>Teaser</article><p>End.", "A long text of the page itself, with all its words.\nTeaser\nEnd."),
        ("<p>Top<article>The first half of it</article><p>Between<article>the other half</article><p>End", "The first half of it\nBetween\nthe other half"),
        ("<article hidden>gone</article><main><p>A</main>", "A"),
    ],
)
def test_main_text_of_one_page(html, text):
    assert page_diff.main_text(page_diff.Page((1, ""), None, "", page_diff.blocks(html)), None, None) == text


class Articles(HTMLParser):
    """A plain reading of pages that keep their text in an article: words by block."""

    BLOCKS = ("article", "p", "h1", "h2", "h3", "ul", "ol", "li", "div", "blockquote", "section", "table", "tr", "td", "pre")
    SKIPPED = ("nav", "header", "footer", "aside", "form", "script", "style", "head")

    def __init__(self):
        super().__init__()
        self.blocks, self.inside, self.skipped = [""], 0, []

    def handle_starttag(self, tag, attrs):
        if self.skipped:
            self.skipped += [tag] if tag == self.skipped[0] else []
        elif tag in self.SKIPPED or "ad" in (dict(attrs).get("class") or "").split():
            self.skipped = [tag]
        elif tag in self.BLOCKS:
            self.inside += tag == "article"
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if self.skipped:
            self.skipped = self.skipped[:-1] if tag == self.skipped[0] else self.skipped
        elif tag in self.BLOCKS:
            self.inside -= tag == "article"
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.skipped:
            self.blocks[-1] += data


def test_whole_table_against_a_plain_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in page_diff.extract(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows) > 200
    for r in rows:
        parser = Articles()
        parser.feed(r.html)
        parser.close()
        lines = [" ".join(block.split()) for block in parser.blocks]
        assert found[r.page_id] == "\n".join(line for line in lines if line), r.page_id


@pytest.mark.parametrize("seed", range(6))
def test_common_lines_are_longest(seed):
    rng = random.Random(seed)
    a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in "xy")
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    found = sorted(page_diff.common_lines(a, b))
    assert len(found) == best[-1][-1]
    rest = iter(b)
    assert all(any(a[i] == y for y in rest) for i in found)


def test_shared_lines_go_outside_articles(spark, monkeypatch):
    monkeypatch.setattr(page_diff, "default_parallelism", lambda _: 1)
    plain = "<body><p>Template</p><p>Own {0}</p><p>More {0}</p><p>Legal</p></body>"
    article = "<body><p>Template</p><article><p>Same text</p></article></body>"
    rows = [(k, f"http://h.example/a/{k}?q=1", plain.format(k), 1, "x") for k in range(4)]
    rows += [(10, "http://h.example/b/1", article, 1, "x"), (11, "http://h.example/b/2", article, 1, "x")]
    rows += [(20, "http://other.example/1", plain.format(20), 1, None), (21, None, plain.format(21), None, None), (22, "nonsense", None, 1, "")]
    rows += [(23, "http://h.example/e", "", 1, None), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    found = page_diff.extract(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert all(texts[k] == f"Own {k}\nMore {k}" for k in range(4) if texts[k].count("\n") == 1)
    assert sum(texts[k].count("\n") == 1 for k in range(4)) >= 2
    assert texts[10] == texts[11] == "Same text"
    assert texts[20] == "Template\nOwn 20\nMore 20\nLegal" and texts[21].startswith("Template") and texts[22] == texts[23] == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert page_diff.extract(pages.limit(0)).count() == 0
