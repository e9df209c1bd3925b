"""Main text of pages: literal cases and the given pages."""

import pytest

from sourcelens.llm.html_text import extract, main_text

SIDE = ("<div id=nav><a href=/>Home</a> <a href=/x>News</a></div><aside><p>Popular, now, here, today, yes, and more of it.</p></aside>"
        "<div class='cookie-notice'><p>We use cookies, as all do, to track, to sell, and to annoy.</p></div>")
TAIL = ("<section class=comments><p>First, nice, post, well, said, thanks, all.</p></section><form><label>Name</label><input></form>"
        "<footer><p>Copyright, imprint, contact, terms, and so on, and on.</p></footer><script>var a = '<p>no</p>';</script>")


@pytest.mark.parametrize("page,text", [
    ("<html><body>" + SIDE + "<article><h1>T&auml;gliches</h1><p>One, two,\n three.<p>Four &lt;five&gt; &amp; six</article>" + TAIL,
     "Tägliches\nOne, two, three.\nFour <five> & six"),
    ("<body>" + SIDE + "<div class=content><div><p>First part, of the story.</p></div><div><p>Second part, of it.</p>"
     "<ul><li>a point<li>another</ul><table><tr><td>cell<td>next</table></div></div>" + TAIL,
     "First part, of the story.\nSecond part, of it.\na point\nanother\ncell\nnext"),
    ("<body><p>Plain page.</p><p>No containers, at all.</p></body>", "Plain page.\nNo containers, at all."),
    ("just text &amp; no tags", "just text & no tags"),
    ("<article><p>cut off in a <b>tag</p><p>last words <a hre", "cut off in a tag\nlast words"),
    ("<article><p>a < b and c > d</p><!-- <p>x</p> --><p>e<br>f</p>", "a < b and c > d\ne f"),
    ("<article><header><h1>Title</h1></header><p>Body, text.</p><div class='share-buttons'>Share</div></article>", "Title\nBody, text."),
    ("<nav><a href=1>only</a></nav><footer>furniture</footer>", ""),
    ("", ""), ("<>", "<>"), ("<p>", ""),
])
def test_main_text(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages_are_read_whole():
    body = "".join(f"<p>Paragraph {i}, with a comma, and words.</p>" for i in range(20_000))
    assert main_text(f"<body>{SIDE}<article>{body}</article>{TAIL}").count("\n") == 19_999
    assert main_text("<div>" * 3_000 + "deep, text" + "</div>" * 3_000) == "deep, text"
    assert main_text("<p " + "a=\"'" * 20_000 + ">rest") in ("rest", "")


def test_every_page_has_a_row(llm):
    rows = [(1, "u", "<article><p>x</p></article>", "clash"), (2, None, None, "clash"), (2, None, None, "clash"), (3, "v", "", "clash")]
    out = extract(llm.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in out) == [(1, "x", 1), (2, "", 0), (2, "", 0), (3, "", 0)]
    assert extract(llm.createDataFrame([], "page_id long, url string, html string")).count() == 0


LONG_P = "<p>" + "Words, of a long, paragraph, here, " * 11 + "end.</p>"


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")])
def test_uneven_sections_and_short_tails_stay(wrap):
    page = (f"<body>{SIDE}{wrap[0]}<header><h1>Title</h1></header><section>{LONG_P * 25}</section>"
            f"<section>{LONG_P * 5}</section><div>The end.</div>{wrap[1]}{TAIL}")
    lines = main_text(page).split("\n")
    assert len(lines) == 31 + (wrap[0] != "<div>") and lines[-1] == "The end."
    assert (lines[0] == "Title") == (wrap[0] != "<div>")  # a header outside of article and main is furniture


@pytest.mark.parametrize("wrapper", ['class="content has-sidebar"', 'class="post comments-open"', 'id="page" class="no-banner"',
                                     'class="with-sidebar"', 'class="layout sidebar-left"'])
def test_wrappers_with_words_of_furniture_keep_their_text(wrapper):
    page = f"<body><div {wrapper}><h1>Title</h1>{LONG_P * 3}<div class='comment-body'><p>Nice, post.</p></div></div>{TAIL}"
    assert main_text(page).split("\n")[0] == "Title" and main_text(page).count("end.") == 3
    assert "Nice" not in main_text(page)


def test_a_page_of_furniture_names_only_is_read_again():
    assert main_text("<body><span class=banner>Only, words.</span></body>") == "Only, words."
    assert main_text("<body><div class=notice><p>One, two.</p></div><div class=promo><p>Three, four.</p></div></body>") == (
        "One, two.\nThree, four.")


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(depth):
        page = "<body>" + "".join(f"<div>text {i}, with a comma" for i in range(depth)) + "</div>" * depth
        began = time.time()
        assert main_text(page)
        return time.time() - began

    assert seconds(20_000) < 30 * max(seconds(2_000), seconds(2_000)) + 1
