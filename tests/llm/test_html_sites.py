import html
import re

import pytest

from emberlog.llm import html_sites as sites


def text_of(source):
    return sites.main_text(sites.Page(source, {}), frozenset())


@pytest.mark.parametrize(("source", "expected"), [
    ("", ""),
    ("<p>a<p>b", "a\nb"),
    ("<div>x <b>y</b>\n z</div>", "x y z"),
    ("<ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table>", "1\n2\na\nb\nc"),
    ("text <scr", "text"),
    ("a < b <script>if(a<b){}</script> c<style>p{}</style>", "a < b c"),
    ("<!-- x --><p>t&nbsp;&amp;&lt;&eacute;&#233;&am", "t &<éé&am"),
    ("<p title=\"a>b\">q</p><p>r", "q\nr"),
    ("x<br>y</p>z", "x y\nz"),
    ("<form><p>no</p></form><p>yes", "yes"),
    ("<h1>A</h1>B<h2>C</h2>", "A\nB\nC"),
    ("<p>end<span class='ad'>buy</span> more</p>", "end more"),
    ("<header>H</header><nav><a>n</a></nav><article><h1>T</h1><p>a</p><div class='comments'><p>hi</p></div>"
     "<aside>no</aside><section class='cookie-notice'>c</section><p>b</p></article><p>out</p><footer>f</footer>", "T\na\nb"),
    ("<main role=main><p>a</p></main><div role='complementary'>s</div><p hidden>h</p>", "a"),
    ("<title>t</title><div class=sidebar>s</div><div class=content>c</div><div style='display: none'>d</div>", "c"),
    ("<textarea>no</textarea><button>no</button><p>yes</p>", "yes"),
])
def test_marked_parts(source, expected):
    assert text_of(source) == expected


def expected_article(source):
    article = re.search(r"<article>(.*?)</article>", source or "", re.DOTALL)[1]
    article = article.replace("<br>", " ").replace("<b>", "").replace("</b>", "")
    blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_sample_pages(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in sites.extract(pages).collect()}
    want = {r.page_id: (r.url, expected_article(r.html), len(expected_article(r.html))) for r in pages.collect()}
    assert got == want


def made_pages(n=30, host="http://h.example/x"):
    """Pages without an article; the banner and the links are the site's, the text is the page's."""
    rows = []
    for i in range(n):
        rows.append((i, host, f"<body><div class=z1><span id=q>Our site</span> is great</div><div class=z2><p>Own text {i * 17}</p><p>More {i}</p></div>"
                              f"<div class=z3><p>See also this</p></div></body>"))
    return rows


def test_template_branches_go(spark):
    rows = [*made_pages(), (100, "http://other.example/", made_pages(1)[0][2]), (101, None, None), (102, "x", "")]
    read = sites.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r.page_id: r.text for r in read}
    assert got[4] == "Own text 68\nMore 4"
    # The banner and the links, on every page of the host with a tree of its own.
    assert {r.page_id: r.n_template_blocks for r in read} == {**dict.fromkeys(range(30), 2), 100: 0, 101: 0, 102: 0}
    # One page tells nothing about its host.
    assert got[100] == "Our site is great\nOwn text 0\nMore 0\nSee also this"
    assert got[101] == got[102] == ""


def test_importance_of_a_tree(spark):
    tree = sites.style_tree(spark.createDataFrame(made_pages(), "page_id long, url string, html string"))
    rows = tree.where("host = 'h.example'").collect()
    assert {r.pages for r in rows} == {30.0}
    low = sorted(r.importance for r in rows)
    assert low[0] == pytest.approx(0) and low[-1] > 0.5


def test_tree_is_asked_before_marks():
    page = sites.Page("<nav><p>menu</p></nav><article><p>own</p><div class=x><p>spread</p></div></article><div>out</div>", {})
    menu, spread = (path[-1] for text, path, _, _ in page.blocks if text in ("menu", "spread"))
    assert sites.read_by_tree(page, frozenset()) == ("own\nspread", 0)
    assert sites.read_by_tree(page, frozenset((menu, spread))) == ("own", 2)
    # A tree that speaks against all of a page is not followed.
    assert sites.read_by_tree(page, frozenset(p[-1] for _, p, _, _ in page.blocks)) == ("own\nspread", 0)


def test_copies_on_one_host_keep_their_text(spark):
    body = "<article><h1>T</h1><p>one</p></article>"
    rows = [(i, "http://h/", body) for i in range(40)] + [(i, "http://g/", "<div>same</div>") for i in range(50, 70)]
    got = {r.page_id: r.text for r in sites.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got.values()) == {"T\none", "same"} and len(got) == 60


def test_extra_columns_and_empty_table(spark):
    rows = [(1, "http://h/", "<p>a", "x", 1), (1, "http://h/", "<p>a", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, template int")
    assert [r.text for r in sites.extract(pages).collect()] == ["a", "a"]
    assert sites.extract(pages.where("false")).count() == 0


WORDS = ["river", "stone", "cloud", "amber", "wheel", "north", "candle", "meadow", "signal", "harbour"]


def own_words(i, k):
    return " ".join(WORDS[(i * 7 + j * (i + k + 1)) % 10] + str(i * 31 + j * k) for j in range(25))


def test_tree_decides_inside_articles(spark):
    """A branch with an opaque name that recurs in articles goes; a misnamed part with the page's own text stays."""
    def body(i, text):
        return (f"<body><article><h1>T{i}</h1><p>{text}</p><div class=x7><p>Spread the word about us</p></div>"
                f"<section class=social-notice><p>Part {i} {text[::-1]}</p></section>"
                f"<div class=share>Share T{i}</div><div class=comments><p>{own_words(i, 5)}</p></div></article></body>")

    texts = [own_words(i, 1) for i in range(30)]
    rows = [(i, "http://h/", body(i, t)) for i, t in enumerate(texts)]
    # Copies of one page are no recurrence, nor are near copies that differ outside their main part.
    rows += [(100 + i, "http://g/", body(0, texts[0])) for i in range(40)]
    rows += [(200 + i, "http://f/", body(i, texts[0]).replace(texts[0][::-1], "short")) for i in range(40)]
    got = {r.page_id: r.text for r in sites.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == f"T{i}\n{text}\nPart {i} {text[::-1]}"
    assert got[100] == got[139] == f"T0\n{texts[0]}\nSpread the word about us"
    assert got[203] == f"T3\n{texts[0]}\nSpread the word about us"
