"""HTML extraction: the block parser, the field against enumeration, held-out accuracy, defined cases."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extraction as X


def texts(page):
    return [b.text for b in X.blocks(page)]


def test_blocks():
    page = """<!DOCTYPE html><title>no</title><script>var t="</p><p>no";</script><style>p{}</style><!-- no <p>no</p> -->
    <div class="Main-content" id=x><p>one <b>two</b>&amp;\n three<br>four<p>five &lt;p&gt; 1 < 2 &am</div>
    <ul><li>a<li>b <a href="x>y">link</a></ul><img alt="no"><select><option>no</select><p>  </p>tail &nbsp; end"""
    assert texts(page) == ["one two& three four", "five <p> 1 < 2 &am", "a", "b link", "tail end"]
    found = X.blocks(page)
    assert [(e[0], e[1]) for e in found[0].path] == [("div", ("main", "content", "x")), ("p", ())]
    assert found[3].linked == 4 and found[0].linked == 0


@pytest.mark.parametrize("page, want", [
    ("", []), ("plain text", ["plain text"]), ("<p>cut <b", ["cut"]), ("<p>a</p></div></p>b", ["a", "b"]), ("<p title='x>y'>a", ["a"]),
    ("<p title=\"open>a</p><p>b", ["a", "b"]), ("<script>never closed <p>no", []), ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
    ("<a>x</a><a>y</a>", ["xy"]), ("<!-- open", []), ("a</b>c", ["ac"]), ("<P>UP</P>", ["UP"]), ("x\x1c y", ["x y"])])
def test_odd_markup(page, want):
    assert texts(page) == want


def test_forward_backward_gradient_and_viterbi_by_enumeration():
    """Viterbi finds the best of all labellings, and the fitted field makes the given labels likelier than any other."""
    page, labels = X.dressed(["Some words. More of them, here.", "Second paragraph of text."], ["menu"], 5)
    found = X.blocks(page)[:8]
    rng = np.random.default_rng(0)
    field = X.Field(rng.normal(size=X.DIM), rng.normal(size=(3, 2, 2)))
    rows, cols, steps = X.features(found)
    s = np.bincount(rows, field.w[cols], len(found))

    def score(y):
        return sum(s[k] * y[k] for k in range(len(y))) + sum(field.t[steps[k], y[k - 1], y[k]] for k in range(1, len(y)))

    best = max(itertools.product((0, 1), repeat=len(found)), key=score)
    assert field.decode(found).tolist() == [bool(x) for x in best]
    fitted = X.fit([(found, np.array(labels[:8], bool))])
    assert fitted.decode(found).tolist() == labels[:8]


def test_likelihood_grows():
    """The gradient is that of the log-likelihood: few steps raise it, as computed by enumeration."""
    page, labels = X.dressed(["One sentence. Another.", "And one more."], ["about us", "home"], 9)
    found = X.blocks(page)[:7]
    y = tuple(int(x) for x in labels[:7])

    def likelihood(field):
        rows, cols, steps = X.features(found)
        s = np.bincount(rows, field.w[cols], len(found))

        def score(z):
            return sum(s[k] * z[k] for k in range(len(z))) + sum(field.t[steps[k], z[k - 1], z[k]] for k in range(1, len(z)))
        every = [score(z) for z in itertools.product((0, 1), repeat=len(found))]
        return score(y) - np.logaddexp.reduce(every)

    got = [likelihood(X.fit([(found, np.array(y, bool))], steps=n, rate=0.02)) for n in (0, 3, 10, 30)]
    assert got == sorted(got) and got[-1] > got[0] + 0.1


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return X.train(pages, limit=100)


def test_held_out_accuracy(pages, field):
    """Pages that the fit did not see, as they are and re-dressed: held out by the hash order of ids."""
    rows = pages.orderBy(F.xxhash64("page_id").desc()).limit(60).collect()
    right = total = 0
    for r in rows:
        found = X.blocks(r.html)
        want = X.labels_by_markup(found)
        assert field.decode(found).tolist() == want.tolist()
        content, other = ([b.text for b, y in zip(found, want) if y == v] for v in (True, False))
        page, labels = X.dressed(content, other, 7_000_000 + r.page_id)
        found = X.blocks(page)
        assert len(found) == len(labels)
        right += int((field.decode(found) == np.array(labels)).sum())
        total += len(labels)
    assert right / total > 0.97


def test_defined_cases(spark, field):
    page = ("<html><body><nav><a href=x>Home</a></nav><article><h1>A title</h1><p>First   paragraph &eacute;, with words.</p><p>Ok.</p>"
            "<div class='comments'><p>Nice post, thanks.</p></div></article><footer>&copy; example</footer>")
    long = "<html><body><article>" + "<p>A sentence of a long page, again.</p>" * 5000 + "</article><footer>&copy; x</footer></body></html>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, "u", None), (3, "u", ""), (4, "u", "<nav><a>x</a></nav>"), (5, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("id", F.lit("x"))
    got = X.extract(df, field).collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r.text)
    assert len(got) == 7 and by[1] == by[None] * 2
    assert by[1][0] == "A title\nFirst paragraph é, with words.\nOk."
    assert by[2] == [""] and by[3] == [""] and by[4] == [""] and by[5][0].count("\n") == 4999


def test_empty_table_and_pages_without_article(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert X.extract(empty, X.train(empty)).collect() == []
    plain = spark.createDataFrame([(k, "u", "<div><a>menu</a></div><div><p>" + f"Long running text number {k}, with commas. " * 8 + "</p></div>")
                                   for k in range(20)], "page_id long, url string, html string")
    assert X.extract(plain, X.train(plain)).where("text like 'Long running%'").count() == 20


def test_training_reads_one_row_per_id_within_bounds(spark):
    rows = [(1, f"<article><p>{k}</p></article>") for k in range(50)] + [(2, "x" * 100_000), (None, "<article>n</article>")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    field = X.train(df, limit=5)
    assert np.abs(field.w).sum() > 0
