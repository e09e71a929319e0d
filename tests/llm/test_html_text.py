"""Main texts of the edge pages, and of pages made from given articles."""

import html as references
import re

from schoolatlas.llm import html_text
from schoolatlas.llm.html_text import MAIN_TEXT, Page


def parse(html):
    return [Page(html).main_blocks()]


def test_edge_pages(spark, edge):
    pages = spark.read.parquet(f"{edge}/pages.parquet")
    rows = html_text.extract(pages).collect()
    assert len(rows) == pages.count()
    found = {r.page_id: r for r in rows}
    for i in range(8):  # what all pages of the host share goes, the story stays
        assert found[i].text == f"Story {i} & more end{i}" and found[i].n_template_blocks == 3
    assert found[8].text == "A title b cd e f"
    assert found[9].text == "no url after"
    assert (found[10].text, found[10].n_chars) == ("", 0)
    assert [r.text for r in rows if r.page_id == 11] == ["", ""]
    assert found[None].text == "plain < text & stray tags <b> kept"
    assert found[12].text == "one"
    assert found[13].text == "deep tail"
    assert all(r.n_chars == len(r.text) for r in rows)


def test_copies_of_a_page_are_one_page(spark):
    page = "<body><p>the same story</p><p>told again</p></body>"
    rows = [(i, f"http://h.example.org/{i}", page) for i in range(20)]
    rows += [(20 + i, f"http://h.example.org/x{i}", f"<p>other {i}</p>") for i in range(3)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == "the same story told again" for r in found if r.page_id < 20)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        article = page.html[page.html.index("<article>") : page.html.index("</article>")]
        plain = re.sub(r"</?(?:article|p|h1|br)>", " ", article).replace("<b>", "").replace("</b>", "")
        assert found[page.page_id] == " ".join(references.unescape(plain).split())


def test_unwanted_parts():
    body = (
        "<header><h1>Site</h1></header><div role=navigation>menu</div><div id='cookie-notice'>ok?</div>"
        "<div class='sideBar'>s</div><p style='display: none'>h</p><p hidden>h</p><section class=related>r</section>"
        "<div class='adage leaders'>kept</div><select><option>o</select><noscript>n</noscript>"
    )
    assert parse(body)[0] == ["kept"]
    assert parse("<article><header><h2>Title</h2><p>by me</p></header><p>text</article>")[0] == ["Title", "text"]
    assert parse("<article><div class='post-header'><h1>T</h1></div><p>x</article>")[0] == ["T", "x"]
    assert parse("a<br>b <i>c</i>d<ul><li>e<li>f</ul><table><tr><td>g<td>h</table>")[0] == ["a b cd", "e", "f", "g", "h"]
    assert parse("<p title='a>b'>x</p><textarea><p>y</textarea><!-- <p>z -->")[0] == ["x"]
    assert parse("<p>&#233;&nbsp;&amp;lt;</p>")[0] == ["é &lt;"]


def test_elements_nest_to_any_depth():
    deep = "<div>" * 3000 + "<nav>menu</nav><p>kept</p>" + "</div>" * 3000 + "<p>behind</p>"
    assert parse(deep)[0] == ["kept", "behind"]
    inline = "<b>" * 50_000 + "x<p>y</p>" * 200
    assert parse(inline)[0] == ["x", "y"] * 200


def counted_templates(pages, min_pages, share, many):
    """Hosts' recurring subtrees by counting every page's elements in plain Python."""
    seen, by_host = {}, {}
    for page in pages:
        host = re.match(r"https?://([^/:]+)", page.url or "")
        if host:
            host = host[1].lower()
            by_host.setdefault(host, set()).add(page.html)
            for number, *_ in Page(page.html or "").elements:
                seen.setdefault((host, number), set()).add(page.html)
    out = {}
    for (host, number), found in seen.items():
        n = len(found)
        if n >= min_pages and (n >= share * len(by_host[host]) or number & 3 != MAIN_TEXT and n >= many):
            out.setdefault(host, set()).add(number)
    return out


def test_templates_against_a_plain_count(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    for limits in ((5, 0.5, 50), (3, 0.3, 6)):
        rows = html_text.templates(html_text.blocks(pages), *limits).collect()
        found = {r.host: set(r.template) for r in rows}
        assert found == counted_templates(pages.collect(), *limits)
        assert found


def test_templates_alone_give_the_main_text(spark):
    """Without the lists, on hosts of enough pages, what the markup gives and the method agree."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    by_markup = {r.page_id: r for r in html_text.extract(pages).collect()}
    alone = {r.page_id: r.text for r in html_text.extract(pages, lists=False).collect()}
    host = {r.page_id: re.match(r"https?://([^/:]+)", r.url)[1] for r in pages.select("page_id", "url").collect()}
    sizes = {h: list(host.values()).count(h) for h in set(host.values())}
    judged = [i for i in host if sizes[host[i]] >= 5]
    assert len(judged) > 100
    same = sum(alone[i] == by_markup[i].text for i in judged)
    assert same >= 0.9 * len(judged)
    assert all(by_markup[i].n_template_blocks > 0 for i in judged)


def test_large_hosts_and_protected_articles(spark):
    """A notice on a tenth of a large host goes; a paragraph as frequent in articles stays."""
    rows = []
    for i in range(600):
        notice = "<div><p>Closed on Monday for works.</p></div>" if i % 10 == 0 else ""
        quote = "<p>The harbour master said nothing.</p>" if i % 10 == 5 else ""
        rows.append((i, f"http://big.example.org/{i}", f"<body>{notice}<div><p>Story {i} begins and ends.</p></div><article><p>Part {i}.</p>{quote}</article></body>"))
    alone = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), lists=False).collect()}
    assert "Closed" not in alone[0] and "harbour" in alone[5]
    plain = [(i, u, re.sub("</?article>", "", h)) for i, u, h in rows]
    found = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(plain, "page_id long, url string, html string")).collect()}
    assert found[0] == "Story 0 begins and ends. Part 0."  # without a main part paragraphs of one form stay
