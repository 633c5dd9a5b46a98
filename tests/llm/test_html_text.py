import random

from epiloom.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></ul></nav><!-- <p>gone</p> --><div class="ad">Buy this now, it is good.</div>
<div class="cookie-notice">We use cookies &amp; more.</div><header><h1>Site name</h1></header>
<div id="main"><article><h1>Title &amp; more</h1><p><b>First   para&#233;graph has quite a lot of text, so it counts.<br><p>Second paragraph has
text too, with a <a href="x">link</a> in it.</p><ul><li>one item<li>two items</ul><blockquote>Quoted words &lt;here&gt;.</blockquote></article>
<section class="comments"><p>I think this is a very nice article and I would like to comment on it at length.</p></section></div>
<aside>Sidebar text</aside><form><label>Name</label><input></form><footer>&copy; all rights</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == (
        "Title & more\nFirst paraégraph has quite a lot of text, so it counts.\nSecond paragraph has text too, with a link in it.\n"
        "one item\ntwo items\nQuoted words <here>.")


def test_density_without_article_element():
    paras = "".join(f"<p>This is paragraph number {i} and it has a fair amount of plain text in it.</p>" for i in range(6))
    links = "".join(f'<li><a href="/{i}">Some linked headline text number {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div>{paras}</div></div><div><a href='x'>next</a></div></body>"
    got = main_text(page)
    assert got.count("\n") == 5 and got.startswith("This is paragraph number 0") and "headline" not in got


def test_malformed_and_long():
    assert main_text(None) == main_text("") == main_text("<html></html>") == main_text("<script>x") == ""
    assert main_text("plain words") == "plain words" and main_text("a < b &notanentity; c") == "a < b ¬anentity; c"
    rng = random.Random(4)
    bits = ["<p>", "</p>", "<div", ">", "<div class='x\">", "</div>", "text ", "<table><tr><td>", "</tr>", "<!--", "-->", "<script>", "</script>", "&amp", "<a href=\"", "<li>", "</ul>", "<br/>", "<", "'"]
    for _ in range(400):
        main_text("".join(rng.choice(bits) for _ in range(rng.randint(0, 60))))
    assert len(main_text("<div>" * 30_000 + "deep words" + "</div>" * 30_000)) == 10
    assert len(main_text("<p>" + "word " * 200_000 + "</p>")) == 999_999


def test_frame(spark):
    rows = [(1, "u", PAGE, "old"), (2, None, None, None), (2, None, None, None), (None, "v", "", "old")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), keep=["page_id", "url"]).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got)[:3] == [0, 0, 0]
    assert all(r.n_chars == len(r.text) for r in got)
