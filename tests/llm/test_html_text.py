import pytest

from shoplens.llm.html_text import extract, main_text

ARTICLE = "<article><h1>Title</h1><p>First &amp; <b>second</b> part.</p><p>Te.</p></article>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav><a href=/>Home</a></nav>{ARTICLE}<footer>end of it all</footer></body>",
        f"<main><div class='cookie-notice'>We use cookies</div>{ARTICLE}</main>",
        f"<div id=wrap><aside>side side side side side</aside>{ARTICLE}</div>",
        f"<body>{ARTICLE}<section id='comments'><p>{'I disagree strongly. ' * 40}</p></section>",
        f"<form><label>Mail</label><input></form>{ARTICLE}<script>var a='<p>x</p>'</script>",
        f"<div class='has-sidebar'>{ARTICLE}</div><div class='ad banner'>buy buy buy</div>",
        ARTICLE.replace("</p>", "").replace("</b>", ""),
        ARTICLE.replace("<p>Te.", "<!-- <p>no</p> --><p hidden>no</p><p>\n\tTe."),
        ARTICLE.upper().replace("TITLE", "Title").replace("FIRST &AMP; <B>SECOND</B> PART.",
                                                          "First &amp; second part.")
        .replace("TE.", "Te."),
    ],
)
def test_the_article_alone_is_left(page):
    assert main_text(page) == "Title First & second part. Te."


def test_pages_without_article_keep_all_paragraphs_of_the_densest_part():
    body = "".join(f"<p>{'word ' * 30}{k}</p>" for k in range(5))
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(20))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div></body>"
    text = main_text(page)
    assert text.count("word") == 150 and "link" not in text
    assert main_text(f"<body><h1>Head</h1>{body}</body>").startswith("Head word")


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), (None, ""), ("just text", "just text"), ("<p>a<br>b<i>c</i></p>", "a bc"),
        ("<p>&lt;p&gt; &#65;&nbsp;&am &amp</p>", "<p> A &am &"), ("<!-- open", ""), ("<", "<"),
        ("<p title='a > b'>ok</p>", "ok"), ("<script>never closed <p>x", ""),
        ("<a href=\"broken>x</a><p>y</p>", "x y"), ("<nav>only</nav>", ""), ("a < b", "a < b"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


PROSE = "".join(f"<p>{'plain words of a text ' * 12}{k}.</p>" for k in range(5))
LINKS = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(20))


@pytest.mark.parametrize(
    "opening",
    ["<div class='has-sidebar'>", "<div id=page class='site no-sidebar'>", "<div class=with-header>",
     "<div class='search-page'>", "<form method=post>", "<div class=with-comments><div class=search>",
     "<main><h1>T</h1><div class='has-sidebar'>"],
)
def test_wrappers_of_a_whole_page_are_not_dropped(opening):
    talk = f"<div id=comments><p>{'I disagree strongly. ' * 200}</p></div>"
    page = f"<body><nav>{LINKS}</nav><div class=banner>b</div>{opening}<div class=sidebar><ul>{LINKS}</ul></div>"
    page += f"<div><div>{PROSE}</div></div><div class='cookie-notice'>We use cookies</div>{talk}"
    text = main_text(page)
    assert text.count("plain words") == 60
    assert not any(x in text for x in ("link", "cookies", "disagree"))


def test_a_form_around_an_article_is_not_dropped():
    page = f"<body><form id=aspnetForm><div class=menu>menu</div>{ARTICLE}<input></form></body>"
    assert main_text(page) == "Title First & second part. Te."


def test_long_comments_below_a_short_text_are_dropped():
    talk = f"<div class='comments-area'><p>{'I disagree strongly. ' * 200}</p></div>"
    assert main_text(f"<body><div><p>A short text.</p><p>More.</p></div>{talk}") == "A short text. More."


def test_very_long_and_broken_pages_stay_linear():
    assert main_text("<" * 300_000).startswith("<")
    assert len(main_text("<a b=\"" * 50_000)) <= 300_000
    assert len(main_text("<p>" + "word " * 400_000 + "</p>").split()) == 400_000


def test_a_column_of_pages(spark):
    rows = spark.createDataFrame([(1, None), (2, ARTICLE), (2, ARTICLE)], "page_id long, html string")
    texts = [r.text for r in rows.select("page_id", extract("html").alias("text")).orderBy("page_id").collect()]
    assert texts == ["", "Title First & second part. Te.", "Title First & second part. Te."]
    assert rows.limit(0).select(extract("html")).count() == 0
