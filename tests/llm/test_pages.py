import pytest

from tamis.llm import pages

SCHEMA = "page_id long, url string, html string, text string, row int"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div><aside>side</aside>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>er&nbsp;word<br>next<p>Two<ul><li>i<li>j</ul>
<div id="comments"><p>reader</p></div><form>f<p>g</form><script>a<b "</script><p hidden>h</p>
<div class="cookie-notice">c</div>tail &#x41;&copy;</article><footer>foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (PAGE, "Head & line\nOne bolder word next\nTwo\ni\nj\ntail A©"),
        (None, ""),
        ("", ""),
        ("<article><p>cut off <b", "cut off"),
        ("<article><p>x<p>x</article>", "x\nx"),
        ("<main><article>inner</article> outer</main>", "inner\nouter"),
        ("<article>a < b and <3 &lt;p&gt;</article>", "a < b and <3 <p>"),
        ("<article><script>never closed", ""),
        ("<p>no article</p><nav>menu</nav>", "no article"),
        ("<article></article><p>outside</p>", "outside"),
    ],
)
def test_main_text(spark, html, text):
    df = spark.createDataFrame([(1, "http://h/x", html, "clash", 1)], SCHEMA)
    rows = pages.main_text(df).collect()
    assert [(r.page_id, r.url, r.text) for r in rows] == [(1, "http://h/x", text)]


def test_what_pages_of_a_host_share_is_boilerplate(spark):
    menu = "<div>" + " ".join(f"menu{i}" for i in range(9)) + "</div>"
    foot = "<p>all rights are reserved by the owner of this site and others</p>"
    rows = [(i, f"https://a.org/{i}", f"{menu}<p>story {i} is about thing{i} only</p>{foot}", "t", 0) for i in range(4)]
    rows += [(10, "https://b.org/1", rows[0][2], "t", 0)]  # another host: repeated nowhere
    rows += [(20 + i, "https://c.org/1", rows[1][2], "t", 0) for i in range(3)]  # copies are one page
    rows += [(30, None, menu, "t", 0), (31, None, None, "t", 0)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(4):
        assert got[i] == f"story {i} is about thing{i} only"
    for i in (10, 20, 21, 22):
        assert got[i].startswith("menu0") and got[i].endswith("others") and got[i].count("\n") == 2
    assert got[30].startswith("menu0") and got[31] == ""


def story(i, n):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_copies_of_an_article_under_other_menus_keep_it(spark):
    rows = [(i, "http://h/x", f"<div>menu of page {i}</div><p>by author {i}</p><p>{story(0, 60)}</p>", "t", 0) for i in range(3)]
    got = pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.text for r in got) == [f"menu of page {i}\nby author {i}\n{story(0, 60)}" for i in range(3)]


def test_a_mark_in_a_script_is_none(spark):
    notice = "<p>all rights are reserved by the owner of this site and others</p>"
    rows = [(i, "http://h/x", f'<script>"<article>"</script><p>{story(i, 20)}</p>{notice}', "t", 0) for i in range(3)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: story(i, 20) for i in range(3)}


def test_marked_pages_are_evidence(spark):
    """What footers of marked pages say goes from a page without a mark; what their articles say stays."""
    foot, article = "all rights are reserved by the owner of this site and others", story(9, 12)
    rows = [(i, "http://h/x", f"<article>{article}<p>{story(i, 20)}</article><footer>{foot}</footer>", "t", 0) for i in range(3)]
    rows += [(3, "http://h/x", f"<p>{story(3, 20)}</p><p>{foot}</p><p>{article}</p>", "t", 0)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"{article}\n{story(i, 20)}" for i in range(3)} | {3: f"{story(3, 20)}\n{article}"}


def test_what_goes_is_what_brute_force_finds(spark):
    import random

    draw = random.Random(5)
    texts = [" ".join(draw.choice("ab") for _ in range(60)) for _ in range(12)]
    rows = [(i, f"http://h{i % 2}/", f"<p>{text}</p>", "t", 0) for i, text in enumerate(texts)]
    wanted = {}
    for i, text in enumerate(texts):
        words, covered = text.split(), set()
        for at in range(len(words) - pages.DEPTH + 1):
            run = " ".join(words[at : at + pages.DEPTH])
            if sum(f" {run} " in f" {other} " for other in texts[i % 2 :: 2]) >= pages.MIN_PAGES:
                covered |= set(range(at, at + pages.DEPTH))
        wanted[i] = " ".join(w for at, w in enumerate(words) if at not in covered)
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == wanted and any(0 < len(text) < 119 for text in wanted.values())


def test_long_markup_takes_linear_time():
    for part in ("<a '", "<p>" * 3, "&amp", "< ", '<a b="'):
        assert isinstance(pages.blocks("<article>" + part * 20_000), tuple)


def test_no_pages(spark):
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_suffixes_of_marked_pages_are_compared(spark):
    """On a host whose pages all mark their article, what its pages repeat is found, and articles keep it."""
    import random

    draw = random.Random(6)
    texts = [" ".join(draw.choice("ab") for _ in range(60)) for _ in range(12)]
    rows = [(i, f"http://h{i % 2}/", f"<nav>menu {i}</nav><article><p>{text}</article>", "t", 0) for i, text in enumerate(texts)]
    rows += [(20, "http://h0/", f"<article>{story(0, 30)}</article>", "t", 0), (21, "http://h0/", None, "t", 0)]
    rows += [(30 + i, "http://h0/", f"<article>{story(5, 30)}</article><p>other {i}", "t", 0) for i in range(4)]  # one page
    wanted = {20: 0, 21: 0} | {30 + i: 0 for i in range(4)}
    for i, text in enumerate(texts):
        words, covered = text.split(), set()
        for at in range(len(words) - pages.DEPTH + 1):
            run = " ".join(words[at : at + pages.DEPTH])
            if sum(f" {run} " in f" {other} " for other in texts[i % 2 :: 2]) >= pages.MIN_PAGES:
                covered |= set(range(at, at + pages.DEPTH))
        wanted[i] = len(covered)
    got = pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.n_repeated for r in got} == wanted and sum(wanted.values()) > 0
    assert {r.page_id: r.text for r in got if r.page_id < 12} == dict(enumerate(texts))


def test_what_menus_repeat_counts_for_marked_pages(spark):
    quote = story(7, 10)
    rows = [(i, "http://h/", f"<nav>{quote} {i}</nav><article>{story(i, 20)}</article>", "t", 0) for i in range(2)]
    rows += [(2, "http://h/", f"<article>{quote}<p>{story(2, 20)}</article>", "t", 0)]
    got = {r.page_id: (r.n_repeated, r.text) for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: (0, story(0, 20)), 1: (0, story(1, 20)), 2: (10, f"{quote}\n{story(2, 20)}")}
