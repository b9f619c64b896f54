import pytest

from riskmesh.llm.html_text import extract, main_text

P = "the cat sat on the mat and it was of a good kind to be in the house with all of them"
Q = "this is what he had for the day and not one of the others was as good to be with"


@pytest.mark.parametrize("html,want", [
    (f"<body><nav><a href=1>Home</a></nav><article><h1>Title</h1><p>{P}</p><p>Short.</p></article><footer>&copy; x</footer></body>", f"Title\n\n{P}\n\nShort."),
    (f"<header><h1>Site</h1></header><div id=main><p>{P}</p><p>Short.</p><p>{Q}</p></div><div class='comments'><p>{Q}</p></div>", f"{P}\n\nShort.\n\n{Q}"),
    (f"<aside>{P}</aside><form><p>{P}</p></form><div class='cookie-notice'>{P}</div><div class=ad>{P}</div><p>{Q}</p>", Q),
    (f"<ul><li><a href=x>{P}</a></li></ul><p>{Q}</p>", Q),
    (f"<article><p>{P}<script>if (a < b) x('</p>')</script> more &amp; &#233;&lt;b&gt;\n\t end<br>here<!-- no <p> --></p></article>", f"{P} more & é<b> end here"),
    (f"<article><p>{P}</p><p>zxq vbn qwrt plk mnb zxcv asdf qwer zxcv bnml poiu qwer asdf zxcv lkjh mnbv qwer</p></article>",
     f"{P}\n\nzxq vbn qwrt plk mnb zxcv asdf qwer zxcv bnml poiu qwer asdf zxcv lkjh mnbv qwer"),
    (f"<p>zxq vbn qwrt plk mnb zxcv asdf qwer zxcv bnml poiu qwer asdf zxcv lkjh mnbv qwer</p><p>{P}</p>", P),
    (f"<article><p>{P}<p>{Q}<b>unclosed <p>a < b</article><footer>{P}</footer>", f"{P}\n\n{Q}unclosed\n\na < b"),
    (f"<article><p>{P}</p></article><p cla", P), (f"<body class='has-sidebar'><main><p>{P}</p></main>", P),
    (f"<div hidden>{P}</div><div role=navigation>{P}</div><p>{Q}</p>", Q),
    ("<p>only a few words</p>", "only a few words"), ("", ""), (None, ""), ("<script>x", ""), ("plain text", "plain text"),
])
def test_rules(html, want):
    assert main_text(html) == want


RU = "Сегодня утром мы вышли из дома и долго шли вдоль реки, потому что погода была хорошая и никто не спешил домой"
NL = "Vanmorgen gingen wij naar buiten om langs de rivier te wandelen omdat het weer mooi bleef en niemand haast had"
ZH = "今天早上我们走出家门，沿着河边走了很久，因为天气很好，没有人急着回家。" * 4
MENU = "<ul><li><a href=1>Home and all of the news</a></li><li><a href=2>About us and the others</a></li></ul>"


@pytest.mark.parametrize("html,want", [
    (f"<div><p>{P}</p><p>{Q}</p></div>", f"{P}\n\n{Q}"),
    (f"<div class='content no-sidebar'><p>{P}</p><p>{Q}</p></div>", f"{P}\n\n{Q}"),
    (f"<div class='layout has-sidebar'><article><p>{P}</p><p>{Q}</p></article></div>", f"{P}\n\n{Q}"),
    (f"<main><section id='legal-analysis'><p>{P}</p><p>{Q}</p></section></main>", f"{P}\n\n{Q}"),
    (f"<main><section class='related-work'><p>{P}</p><p>{Q}</p></section></main>", f"{P}\n\n{Q}"),
    (f"<form id=aspnetForm>{MENU}<div><p>{P}</p><p>{Q}</p></div><footer>{P}</footer></form>", f"{P}\n\n{Q}"),
    (f"{MENU}<div><h1>Прогулка</h1><p>{RU}</p><p>{RU}.</p></div><footer>{RU}</footer>", f"Прогулка\n\n{RU}\n\n{RU}."),
    (f"{MENU}<div><h1>Wandeling</h1><p>{NL}</p><p>{NL}.</p></div>", f"Wandeling\n\n{NL}\n\n{NL}."),
    (f"<div><p>{ZH}</p></div><div class=sidebar>{RU}</div>", ZH),
    # evidence still counts beside the article, and comments even when they are longer
    (f"<article><p>{P}</p></article><div class='sidebar-left'><p>{Q} {Q} {Q}</p></div>", P),
    (f"<div><p>{P}</p></div><div class=comments><p>{Q}</p><p>{Q} {Q}</p></div>", P),
    (f"<div><p>{P} {P} {P}</p></div><form><p>{Q}</p></form><div class='cookie-notice'>{Q}</div><div id=related-posts>{Q}</div>", f"{P} {P} {P}"),
])
def test_names_are_evidence_and_languages_do_not_matter(html, want):
    assert main_text(html) == want


def test_many_short_blocks_take_linear_time():
    import time
    start = time.process_time()
    text = main_text(f"<div><p>{P}</p>" + "<p>ab cd</p><b>x</b>" * 100_000 + "</div>")
    assert text.count("ab cd") == 100_000 and time.process_time() - start < 20


def test_very_long_and_nested_pages():
    deep = "<div>" * 20_000 + P + "</div>" * 20_000
    assert main_text(deep) == P
    assert main_text("<article>" + f"<p>{P}</p>" * 20_000 + "</article>").count(P) == 20_000
    assert main_text("<a " * 50_000 + ">") == "" and main_text("<p \"" * 20_000) == ""


def test_table(spark):
    rows = [(1, "u", f"<article><p>{P}</p></article>", "x", 3), (1, "u", f"<article><p>{P}</p></article>", "x", 3), (2, None, None, None, None), (None, "v", "", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, got.collect())) == sorted(
        [f"Row(page_id=1, url='u', text={P!r}, n_chars={len(P)})"] * 2 + ["Row(page_id=2, url=None, text='', n_chars=0)", "Row(page_id=None, url='v', text='', n_chars=0)"])
    assert extract(pages.limit(0)).count() == 0
