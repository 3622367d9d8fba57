import numpy as np
import pytest

from weftlink.llm import html_extract as H


@pytest.fixture(scope="module")
def model():
    return H.trained()


def test_blocks():
    page = """<html><head><title>t</title><style>p{}</style></head><body class=x><p>a&amp;b &eacute;<br>c<b>d</b>e<p>f<script>var p="</p>"</script>g<!-- h --><ul><li>i<li>j</ul><td>k<div title="a>b">l</div>m&am <di"""
    assert [t for _, t, _ in H.blocks_of(page)] == ["a&b é cde", "fg", "i", "j", "k", "l", "m&am"]
    assert H.blocks_of("") == H.blocks_of("<p>  </p>") == H.blocks_of("<script>x") == []
    assert H.blocks_of("plain")[0] == ((), "plain", 0)
    assert H.blocks_of('<div class="a-b c" id=d><a href=x>li nk</a> z')[0] == ((("div", ("a", "b", "c", "d")),), "li nk z", 5)


def test_open_head_and_self_closed():
    text = lambda page: [t for _, t, _ in H.blocks_of(page)]
    assert text("<html><head><meta charset=x><title>t</title><script>s</script> <p>a<p>b</html>") == ["a", "b"]
    assert text("<head><link rel=x>\n<style>p{}</style> a <b>b</b><p>c") == ["a b", "c"]
    assert text("<head><title>t</title></head><body><p>a") == ["a"]
    assert text('<div><svg/>a<math class="x"/>b<svg><path d=x /><text>no</text></svg>c</div>') == ["abc"]
    assert text("<div>a<svg class=x/>no</svg>b</div>") == ["ab"]  # the slash is the value's


def test_gradient():
    rng = np.random.default_rng(0)
    model = H.Labeller(rng)
    for k, w in model.w.items():
        model.w[k] = w.astype(np.float64)
    pages = [rng.standard_normal((n, H.INPUTS)) * 0.1 for n in (3, 5)]
    labels = [np.array([1, 0, 1]), np.array([0, 0, 1, 1, 0])]
    _, grad = model.step(pages, labels)
    for name in model.w:
        k = tuple(rng.integers(s) for s in model.w[name].shape)
        old, size = model.w[name][k], 1e-2
        ends = []
        for sign in (1, -1):
            model.w[name][k] = old + sign * size
            ends.append(model.step(pages, labels)[0])
        model.w[name][k] = old
        assert abs((ends[0] - ends[1]) / (2 * size) - grad[name][k]) < 2e-4


def test_held_out_accuracy(model):
    rng = np.random.default_rng(4242)
    right = total = 0
    for _ in range(200):
        page, main = H.generated_page(rng)
        blocks = H.blocks_of(page)
        if blocks:
            y = H._labels(blocks, main)
            right += ((model.scores([H.vectors(blocks)])[0] > 0) == (y > 0)).sum()
            total += len(y)
    assert right > 0.975 * total


def test_pages(spark, model):
    body = "<nav><ul><li><a href=/x>one</a></li><li><a href=/y>two</a></li></ul></nav><div class='ad'>Buy   now.</div><article><h1>Title here</h1><p>First &lt;para&gt;\n of text.</p><p>Second paragraph, which goes on for a while.</p></article><footer>&copy; someone</footer>"
    rows = [(1, "u", body), (2, "u", None), (3, "u", ""), (3, "u", ""), (4, None, "<html><body></body></html>"), (5, "v", body[:-60])]
    got = {r.page_id: (r.text, r.n_chars) for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), model=model).collect()}
    text = "Title here\nFirst <para> of text.\nSecond paragraph, which goes on for a while."
    assert got[1] == (text, len(text)) and got[2] == got[3] == got[4] == ("", 0)
