from epiloom.llm.html_text import main_text


def paragraphs(word, n):
    return "".join(f"<p>{word} paragraph {i} with a fair amount of plain text in it, no links.</p>" for i in range(10, 10 + n))


def test_short_sibling_section_stays():
    for first, second in ((10, 2), (2, 10), (12, 1)):
        got = main_text(f"<body><div>{paragraphs('One', first)}</div><div>{paragraphs('Two', second)}</div></body>").split("\n")
        assert [g.split()[0] for g in got] == ["One"] * first + ["Two"] * second


def test_named_wrappers_keep_the_main_text():
    text = paragraphs("One", 5)
    side = "<div class='sidebar'><p>Latest news</p></div><div class='comments'><p>I like it.</p></div>"
    for open_, close in (("<div class='container has-sidebar'>", "</div>"), ("<div class='post-with-comments'>", "</div>"), ("<section id='related-work'>", "</section>")):
        for inner in (text, f"<article>{text}</article>", f"<main><div class='meta'>{text}</div></main>"):
            for page in (f"<body>{open_}{inner}{side}{close}</body>", f"<body><main>{open_}<article>{text}</article>{side}{close}</main></body>"):
                got = main_text(page).split("\n")
                assert [g.split()[0] for g in got] == ["One"] * 5, page
    # an article named as a comment does not make its list a wrapper
    listing = "<section class='comments'><article class='comment'><p>I like it.</p></article></section>"
    assert main_text(f"<body><article>{text}</article>{listing}</body>").count("\n") == 4


def test_named_wrapper_below_the_content_is_left_out():
    more = "<div class='related'><article><a href='/x'>Another story</a></article></div>"
    got = main_text(f"<body><main>{paragraphs('One', 6)}{more}</main></body>")
    assert got.count("\n") == 5 and "Another" not in got


def test_long_advert_beside_a_short_article_goes():
    assert main_text(f"<body><div class='ad'>{paragraphs('Buy', 3)}</div><article><p>Short.</p></article></body>") == "Short."
