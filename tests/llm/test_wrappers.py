"""HTML extraction: cases where a short cut would lose text or keep the template."""

import random

from logloom.llm import wrappers


def test_hidden_elements_end_without_end_tags():
    assert wrappers.extracted("<html><head><title>t</title><meta charset=x><body><p>a") == "a"
    assert wrappers.extracted("<head><title>t</title><div>a</div>") == "a"
    assert wrappers.extracted("<head><script>x</script>plain") == "plain"
    assert wrappers.extracted("<p hidden>x<b>y<p>a<p style='display: none'>z<div>b</div>") == "a\nb"
    assert wrappers.extracted("<ul><li hidden>x<li>a</ul><ul><li>b<li hidden>y</ul>c") == "a\nb\nc"
    assert wrappers.extracted("<table><tr hidden><td>x<td>y<tr><td hidden>z<td>a</table>b") == "a\nb"
    assert wrappers.extracted("<dl><dt hidden>x<dd>a<dd hidden>y</dl><p>b") == "a\nb"
    assert wrappers.extracted("<div hidden><ul><li>x</ul><p>y</div>a") == "a"


def test_deep_blocks_close_nothing_else():
    deep = "<div>" * 70
    page = "<body><div>out<div><article>%s" + deep + "<p>in<p>two" + "</div>" * 70 + "<p>rest</article></div>out</div>"
    assert wrappers.extracted(page % "") == "in\ntwo\nrest"
    assert wrappers.extracted(deep + "a<div>b</div>c" + "</div>" * 70 + "<p>d") == "a\nb\nc\nd"
    assert wrappers.extracted(deep + "x<article>long one<nav>y<nav>y</nav>y</nav>b</article>z" + "</div>" * 70 + "z") == "long one\nb"
    assert wrappers.extracted("a" + "<nav>" * 5000 + "x" + "</nav>" * 5000 + "b") == "a\nb"


def _words(pick, n):
    return " ".join(f"w{pick.randrange(10**6)}" for _ in range(n))


def test_the_wrapper_decides_inside_articles(spark):
    pick = random.Random(1)
    rows, want = [], {}
    for k in range(20):
        body = [_words(pick, 12) for _ in range(3)]
        html = "<body><div>Site</div><article><div class='q'>Buy our paper today</div>" + "".join(f"<p>{b}</p>" for b in body) + "<div class='r'>All rights</div></article></body>"
        rows.append((k, f"http://h.example/{k}", html))
        want[k] = "\n".join(body)
        text = _words(pick, 60)
        rows.append((100 + k, f"http://g.example/{k}", f"<body><article>{_words(pick, 3)}</article><div>{text}</div></body>"))
        want[100 + k] = rows[-1][2][15:].split("</article>")[0] + "\n" + text
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_copies_do_not_turn_the_template_off(spark):
    pick = random.Random(2)
    texts = [_words(pick, 10) for _ in range(10)]
    page = "<body><div class='x'>Site menu</div><div class='z'>%s</div></body>"
    rows = [(k, "http://h.example/", page % texts[k]) for k in range(10)] + [(100 + k, "http://h.example/", page % texts[0]) for k in range(90)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: texts[k] if k < 10 else texts[0] for k in got} and len(got) == 100


def _trees(pick, depth):
    return [pick.choice("abc"), 1, 0, 0, {}, [_trees(pick, depth - 1) for _ in range(pick.randint(0, 4) if depth else 0)], False]


def _best(a, b):
    """Simple tree matching by trying every pair of first children."""
    if a[0] != b[0]:
        return 0

    def lists(x, y):
        if not x or not y:
            return 0
        pair = _best(x[0], y[0])
        return max(lists(x[1:], y), lists(x, y[1:]), pair and pair + lists(x[1:], y[1:]))

    return 1 + lists(a[5], b[5])


def test_alignment_is_a_best_matching():
    pick = random.Random(5)
    for _ in range(300):
        a, b = _trees(pick, 3), _trees(pick, 3)
        a[0] = b[0]
        best = _best(a, b)
        assert wrappers.matching(a, b) == best
        pairs = wrappers.aligned(a[5], b[5])
        assert [i for i, _ in pairs if i is not None] == list(range(len(a[5]))) and [j for _, j in pairs if j is not None] == list(range(len(b[5])))
        both = [(i, j) for i, j in pairs if i is not None and j is not None]
        assert all(a[5][i][0] == b[5][j][0] for i, j in both) and 1 + sum(_best(a[5][i], b[5][j]) for i, j in both) == best


def test_long_unlike_pages_merge():
    def page(k):
        return "".join(f"<h2>t{i}</h2><p>x</p>" + ("<div class='q'><ul><li>a</ul></div>" if i * k % 7 == 3 else "") for i in range(4000))

    one, two = (wrappers.as_wrapper(wrappers.parsed(page(k))) for k in (2, 3))
    whole = wrappers.merged(one, two)
    assert whole[1] == 2 and len(one[5]) <= len(whole[5]) < len(one[5]) + len(two[5]) / 10
    nested = [wrappers.as_wrapper(wrappers.parsed("".join("<div><section><h2>x</h2>" + "<p>a</p><h3>b</h3>" * (i * k % 5) + "</section></div><h4>q</h4>" for i in range(1000)))) for k in (2, 3)]
    assert wrappers.merged(*nested)[1] == 2


def test_rare_nodes_leave_the_wrapper():
    leaf = lambda label, pages: [label, pages, 0, 0, {}, [], False]
    whole = ["#", 5000, 0, 0, {}, [leaf("a", 5000), leaf("b", 4), leaf("c", 5)], False]
    assert [c[0] for c in wrappers.common(whole, 5000)[5]] == ["a", "c"]
    assert wrappers.common([*whole[:5], [leaf("b", 1)], False], 1000)[5]


def test_names_that_articles_use_are_a_prior(spark):
    for name in ("menu-item", "related-work", "alert-level", "discussion"):
        assert wrappers.extracted(f"<body><article><p>a</p><div class='{name}'>b</div></article></body>") == "a\nb"
    assert wrappers.extracted("<body><p>a</p><div id='discussion'><p>Results discussion</p></div>") == "a\nResults discussion"
    for name in ("menu", "related-articles", "alert-box", "ad-slot", "comments", "menu-item sidebar"):
        assert wrappers.extracted(f"<body><article><p>a</p><div class='{name}'>b</div></article></body>") == "a"
    pick = random.Random(6)
    rows, want = [], {}
    for k in range(20):
        text, own = _words(pick, 12), _words(pick, 4)
        # constant on 12 of 20 pages; nearly all link text; varying text
        notice = "Read this" if k < 12 else _words(pick, 3)
        html = f"<body><article><p>{text}</p><div class='alert-level'>{notice}</div><div class='related-work'>see <a href=x>{_words(pick, 3)}</a></div><div class='menu-item'>{own}</div></article></body>"
        rows.append((k, "http://h.example/", html))
        want[k] = f"{text}\n{own}"
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_inline_adverts():
    assert wrappers.extracted("<p>a <span class='ad'>AD <b>x</b></span>b <a class='sponsored-link' href=x>y</a>c<i class='address'>d</i>") == "a b cd"
    assert wrappers.extracted("<p>a<span class='ad'>never ended</p><p>b") == "a\nb"


def test_the_wrapper_alone_finds_articles(spark, sf_dir):
    """Without article tags and names: constant parts and link lists go, the whole article stays."""
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").where("html is not null")
    plain = [
        (r.page_id, r.url, re.sub(r"""\s(class|id|role)=("[^"]*"|'[^']*')""", "", re.sub(r"<(/?)(article|nav|footer|header|aside|main)\b", r"<\1div", r.html)))
        for r in pages.collect()
    ]
    with_names = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(plain, "page_id long, url string, html string")).collect()}
    assert got.keys() == with_names.keys()
    assert sum(text in got[k] for k, text in with_names.items()) >= 0.95 * len(got)
