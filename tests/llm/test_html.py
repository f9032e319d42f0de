import re
import time
from html import unescape

from terminus.llm.common import table
from terminus.llm.html import content_stream, extract, inside, main_text, merge, outline, rules


def plain(html):
    """Another way for pages whose article is one element: cut it out, drop tags."""
    m = re.search(r"<article[^>]*>(.*?)(?:</article>|\Z)", html or "", re.S)
    if not m:
        return ""
    body = re.sub(r"<(p|/p|h1|/h1)(\s[^>]*)?>", "\0", m[1])
    body = re.sub(r"<br\s*/?>", " ", body)
    body = re.sub(r"<[^>]*(>|\Z)", "", body)
    return " ".join(x for b in body.split("\0") if (x := " ".join(unescape(b).split())))


def test_all_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: (r.url, plain(r.html), len(plain(r.html))) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in extract(pages).collect()}
    assert got == want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>a{{}}</style></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><a>Home</a></nav><div class="cookie-notice">We use cookies</div>
<div class="{c}"><h1>{t} &amp;&#x41;</h1><p>One  <b>b</b>old<span>er</span> {t}<br>next</p><ul><li>x{t}<li>y{t}</ul><p>Always the same</p></div>
<div id="comments"><p>Nice {t}</p></div><form>Mail <input></form><aside>Side {t}</aside><!-- c {t} --><script>if (a < b) "</p>"</script>
<footer>&copy; {t}</footer></body></html>"""


def test_wrapper_without_article(spark):
    wrapper = content_stream(PAGE.format(c="post", t="a"))
    for t in "bc":
        wrapper = merge(wrapper, content_stream(PAGE.format(c="post", t=t)))
    rule = rules(wrapper)
    assert main_text(PAGE.format(c="post", t="q"), rule) == "q &A One bolder q next xq yq Always the same" or main_text(PAGE.format(c="post", t="q"), rule) == "q &A One bolder q next xq yq"
    frame = spark.createDataFrame([(i, f"http://h/{i}", PAGE.format(c="post", t="abc"[i]), "z") for i in range(3)], "page_id long, url string, html string, text string")
    assert all(r.text.startswith(f"{'abc'[r.page_id]} &A One bolder {'abc'[r.page_id]} next") and "cookies" not in r.text and "Nice" not in r.text for r in extract(frame).collect())


def test_article_and_edges(spark):
    art = "<article class='post sidebar'><header>By <i>me</i></header><p>a<p>b &lt; c &am<div class=comments>no</div><section id='comment-list'>no</section><p>d<table><tr><td>1<td>2</table>tail</article>after"
    assert main_text(art) == "By me a b < c &am d 1 2 tail"
    assert main_text("<main><p>x</p></main><p>y") == "x"
    assert main_text("<article>a <a href='x' clas") == "a"
    assert main_text("<article>a <!-- b") == "a" and main_text("<article>a<script>b") == "a"
    assert main_text(None) == main_text("") == "" and main_text("a < b") == "a < b"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    deep = content_stream("<div>" * 1500 + "deep")
    assert merge(deep, content_stream("<div>" * 1500 + "other"))[0][3] == ""
    frame = spark.createDataFrame([(1, None, None), (2, None, ""), (3, "x", "<p>a</p>"), (3, "x", "<p>a</p>"), (None, "http://u@H:8/", "<article>é\U0001f600")], "page_id long, url string, html string")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in extract(frame).collect()))
    assert got == [(0, "é\U0001f600", 2), (1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1)]
    assert extract(frame.limit(0)).count() == 0


def test_optional_and_repeated():
    a = content_stream("<div><h1>x</h1><p>1<p>2</div>")
    b = content_stream("<div><h1>y</h1><h2>z</h2><p>3</div>")
    w = merge(a, b)
    assert outline(inside(w)[0]) == [("h1", 0, 0), ("h2", 1, 0), ("p", 0, 1)]
    c = content_stream("<div><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></div>")
    assert outline(inside(c)[0]) == [("()", 0, 1)]
    d = merge(content_stream("<div><h1>x</h1><p>1</p><hr><ul><li>a</ul></div>"), content_stream("<div><h1>y</h1><p>2</p><p>3</p><blockquote>q</blockquote><ul><li>b<li>c</ul></div>"))
    assert outline(inside(d)[0]) == [("h1", 0, 0), ("p", 0, 1), ("blockquote", 1, 0), ("ul", 0, 0)] and outline(inside(inside(d)[0])[3]) == [("li", 0, 1)]


def test_only_real_attributes_and_whole_names_mark():
    for inner in ('<div style="overflow:hidden">t</div>', '<p title="the hidden cost">t</p>', '<a href="/posts/hidden-gems">t</a>', '<a href="/x?id=search">t</a>', "<p data-x='a class=ads'>t", '<section id="related-work">t</section>', '<section id="search-methods">t</section>', '<p data-hidden>t'):
        assert main_text(f"<article>{inner}</article>") == "t", inner
    assert main_text('<div class="content has-sidebar"><p>t</div>') == "t"
    for inner in ("<p hidden>t", "<p HIDDEN=''>t", "<p aria-hidden=true>t", "<div class='x related-posts'>t</div>", "<div id=siteHeader>t</div>", "<div role = 'search'>t</div>"):
        assert main_text(f"<article>{inner}</article>") == "", inner


def test_raw_content_ends_at_its_end_tag():
    for inner in ("<script>for(i=0;i<n;i++){}</script>", "<script>a='<!--'</SCRIPT >", "<style>a<b{}</style>", "<svg><path d='x'/></svg>", "<svg/>", "<svg>", "<noscript>", "<iframe>", "<template>", "<script>'</scripts>'</script>"):
        assert main_text(f"<article>a{inner}<p>b</article>") in ("a b", "ab"), inner
    assert main_text("<article>a" + "<svg>" * 20000 + "b").startswith("a")


def wrapped(*pages):
    wrapper = content_stream(pages[0])
    for p in pages[1:]:
        wrapper = merge(wrapper, content_stream(p))
    return rules(wrapper)


def test_all_blocks_of_one_page_and_of_sibling_sections():
    one = "<div><h1>T</h1><p>a</p><p>b</p></div>"
    assert main_text(one, wrapped(one)) == main_text(one, wrapped(one, one)) == "T a b"
    page = "<body><p>Our site</p><div><section class=intro><p>i{0}</section><section class=body><p>b{0} and much more text<p>c{0}</section><p>p{0}<ul><li>l{0}</ul></div></body>"
    assert main_text(page.format(1), wrapped(page.format(1), page.format(2))) in ("i1 b1 and much more text c1 p1 l1", "Our site i1 b1 and much more text c1 p1 l1")
    split = "<body><h5>Our site</h5><div><h1>T{0}</h1><p>a{0}<ul><li>l{0}</ul></div><section><p>b{0}</section></body>"
    assert main_text(split.format(1), wrapped(split.format(1), split.format(2))) == "T1 a1 l1 b1"


def test_wrapper_decides_on_pages_with_article():
    teasers = "<body><article><p>t{0}</article><article><p>u{0}</article><div><p>the real text of page {0} is long</div></body>"
    assert main_text(teasers.format(1), wrapped(teasers.format(1), teasers.format(2))) == "t1 u1 the real text of page 1 is long"
    page = "<body><div>x{0}</div><article><p>text of {0}</p><h6>Read our paper</h6></article></body>"
    assert main_text(page.format(1), wrapped(page.format(1), page.format(2))) == "text of 1"


def test_alignment_grows_with_the_tokens_alone():
    wide = ["<div>" + "".join(f"<section class=c{(i * k) % 5003}>t{i}</section>" for i in range(5000)) + "</div>" for k in (1, 7)]
    began = time.time()
    merge(*map(content_stream, wide))
    assert time.time() - began < 20
