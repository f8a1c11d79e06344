import html as entities
import itertools
import re

import numpy as np
import pytest

from acreage.llm import crf, html


@pytest.fixture(scope="module")
def model():
    return html.default_model()


def test_held_out_pages(model):
    wrong = total = 0
    for page, kept in html.labelled_pages(150, seed=77):
        b = html.blocks(page)
        y = html.labels(b, kept)
        assert sum(y) == len(kept)
        wrong += sum(p != q for p, q in zip(y, model.decode(html.features(b))))
        total += len(y)
    assert wrong / total < 0.02


def test_viterbi_is_the_best_of_all_labellings():
    r = np.random.default_rng(1)
    chain = crf.Chain({f"f{i}": float(r.normal()) for i in range(5)}, tuple(r.normal(size=2)), tuple(map(tuple, r.normal(size=(2, 2)))))
    for n in range(1, 8):
        rows = [[f"f{i}" for i in range(5) if r.random() < 0.5] for _ in range(n)]
        g = chain.gains(rows)

        def total(y):
            return chain.start[y[0]] + sum(a * b for a, b in zip(g, y)) + sum(chain.step[a][b] for a, b in zip(y, y[1:]))

        assert total(chain.decode(rows)) == pytest.approx(max(map(total, itertools.product((0, 1), repeat=n))))


def test_training_reaches_the_maximum():
    r = np.random.default_rng(2)
    pages = []
    for _ in range(60):
        y = [int(r.random() < 0.5)]
        while len(y) < 8:
            y.append(y[-1] if r.random() < 0.9 else 1 - y[-1])
        pages.append(([["all", "yes" if (r.random() < 0.8) == bool(v) else "no"] for v in y], y))
    chain = crf.train(pages, rounds=400, rate=0.05)

    def loss(c):
        out = 0.0
        for rows, y in pages:
            g = c.gains(rows)
            score = lambda z: c.start[z[0]] + sum(a * b for a, b in zip(g, z)) + sum(c.step[a][b] for a, b in zip(z, z[1:]))  # noqa: B023, E731
            alls = np.array([score(z) for z in itertools.product((0, 1), repeat=len(y))])
            out += np.log(np.exp(alls - alls.max()).sum()) + alls.max() - score(y)
        return out

    best = loss(chain)
    for name in chain.emission:
        for d in (-0.2, 0.2):
            assert loss(crf.Chain(chain.emission | {name: chain.emission[name] + d}, chain.start, chain.step)) > best - 0.05
    assert chain.step[0][0] > chain.step[0][1] and chain.emission["yes"] > chain.emission["no"]


def article(page):
    """The article of a page of the tables, read off its markup."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    found = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in found if x)


def test_query_over_whole_table(spark):
    from acreage.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op7_html_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_broken_markup(model):
    text = lambda h: [b.text for b in html.blocks(h)]
    assert text("") == [] and text("a &amp; b &#233;&lt;") == ["a & b é<"]
    assert text("<p>one<p>two</div><b>three<div>four") == ["one", "two", "three", "four"]
    assert text("<script>var x='</p>';<p>no</script>yes<style>no") == ["yes"]
    assert text("<p>a\n  b<br>c</p><!-- no -->d<") == ["a b c", "d<"]
    assert [b.tag for b in html.blocks("<ul><li>a<li>b</ul>c")] == ["li", "li", ""]
    html.main_text("<div>x" * 20_000 + "</a>" * 20_000, model)
    html.main_text("<" * 20_000, model)


def test_nulls_repeats_and_extra_columns(spark):
    page = "<nav><a href=x>home</a></nav><article><p>Some words, in a sentence.</p></article><footer>&copy; x</footer>"
    rows = [(1, page, "old", "u"), (1, page, "old", "u"), (2, None, None, None), (3, "", "y", "v")]
    docs = spark.createDataFrame(rows, "page_id bigint, html string, text string, url string")
    got = html.extract(docs)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, "u", "Some words, in a sentence.", 26)] * 2 + [(2, None, "", 0), (3, "v", "", 0)], key=repr)
    assert html.extract(docs.limit(0)).count() == 0
