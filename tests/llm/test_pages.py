"""Extraction from pages written by hand; none of them comes from the layouts that the model is trained on."""

import pytest

from wicketflow.llm import html_extract
from wicketflow.llm.common import table

PARAGRAPHS = ["The river rose again on Monday, and the lower fields stood under water for the third time this year.",
     "Farmers who had moved their cattle in spring were spared the worst of it. Others lost fences, feed and a good part of the hay.",
     "\"We knew it would come,\" said one of them, \"but not that it would come twice in a month.\"",
     "The council has promised a new dyke. It said the same in 2011, and in 2016, and plans have been drawn up each time.",
     "Whether the money will be found now is another question; the region's budget for flood works was cut by a fifth last winter.",
     "For the time being the villages rely on sandbags, on pumps lent by the army, and on neighbours."]
BODY = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)
MENU = "<ul><li><a href=/a>Home</a></li><li><a href=/b>World</a></li><li><a href=/c>Sport</a></li><li><a href=/d>Contact us</a></li></ul>"
FOOT = "&copy; 2024 The Valley Post. All rights reserved. <a href=/t>Terms</a> <a href=/p>Privacy</a>"
PAGES = {
    "body names": (f"<body class='has-sidebar has-footer'><main>{BODY}</main><div class=footer>{FOOT}</div></body>", PARAGRAPHS),
    "wrapper names": (f"<body><div class=nav>{MENU}</div><div class='post sidebar-right header-image'>{BODY}</div><footer>{FOOT}</footer></body>", PARAGRAPHS),
    "neutral": (f"<body><div class=k1>{MENU}</div><div class=k2><h1>Floods return</h1>{BODY}</div><div class=k3><h3>2 comments</h3><div class=k4><b>Jo</b><p>Same every year, nobody learns.</p><a href=#>Reply</a></div><div class=k4><b>Al</b><p>Thoughts with the farmers.</p><a href=#>Reply</a></div></div><div class=k5>{FOOT}</div></body>", ["Floods return", *PARAGRAPHS]),
    "table": (f"<table><tr><td colspan=2><a href=/>The Valley Post</a></td></tr><tr><td>{MENU}</td><td><h1>Floods return</h1>{BODY}</td></tr><tr><td colspan=2>{FOOT}</td></tr></table>", ["Floods return", *PARAGRAPHS]),
    "plain divs": (f"<div><div>{MENU}</div><div><div><h1>Floods return</h1>{BODY}</div></div><div>{FOOT}</div></div>", ["Floods return", *PARAGRAPHS]),
    "cookie": (f"<body><div id=cookie-consent>We use cookies to make this site work. <button>Accept</button> <a href=/c>More</a></div><header><a href=/>Post</a>{MENU}</header><article>{BODY}<aside><h4>Related</h4><ul><li><a href=/r>Dykes: a history</a></li></ul></aside></article><footer>{FOOT}</footer></body>", PARAGRAPHS),
    "comments open": (f"<body class='single with-comments'><div id=page><section id=story>{BODY}</section><section id=respond><h3>Leave a reply</h3><form><label>Name</label><input name=n><textarea>x</textarea></form></section></div></body>", PARAGRAPHS),
    "sidebar text": (f"<body><div id=wrap><div id=left class=sidebar><h3>About</h3><p>The Valley Post is written by volunteers since 1987.</p>{MENU}</div><div id=content>{BODY}</div></div><div id=footer>{FOOT}</div></body>", PARAGRAPHS),
}


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.fit(table(spark, "/root/testdata/sf0.01", "pages"))


@pytest.mark.parametrize("name", PAGES)
def test_hand_written_pages(model, name):
    page, want = PAGES[name]
    assert html_extract.extract(page, model) == " ".join(want)


def test_a_very_long_page(model):
    paragraphs = [f"Paragraph {k} of a very long page goes on for a while and then it ends." for k in range(3000)]
    page = f"<body><nav>{MENU}</nav><article>{''.join(f'<p>{p}</p>' for p in paragraphs)}</article><footer>{FOOT}</footer></body>"
    assert html_extract.extract(page, model) == " ".join(paragraphs)


def test_repeated_rows(spark, model):
    page, want = PAGES["neutral"]
    rows = [(1, "u", page)] * 3 + [(None, None, page)]
    got = html_extract.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"), model).collect()
    assert sorted(str(r.page_id) for r in got) == ["1", "1", "1", "None"] and {r.text for r in got} == {" ".join(want)}


def test_inline_marks_do_not_part_words():
    nodes = html_extract.parse("<p>foo<wbr>bar <img src=x>baz<br>q</p>")
    assert html_extract.main_text(nodes, [True] * len(nodes)) == "foobar baz q"


def test_tokens_are_learned_from_labels():
    node = lambda label, *tokens: html_extract.Node("div", 0, 1, tokens, [], label)
    pages = [[node(0, "x1", "both"), node(1, "y1", "both")] for _ in range(50)] + [[node(0, "rare")]]
    odds = html_extract.token_odds(pages)
    at = lambda t: odds[html_extract._bin(t)]
    assert at("x1") < -2 < 2 < at("y1") and abs(at("both")) < 0.1 and -0.5 < at("rare") < 0
    assert html_extract.attribute_tokens("has-sidebar") == ("has", "sidebar", "has-sidebar")
