"""Chat rotation and page extraction on small cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.llm import chat, html_crf

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Site</a> Best news</header>
<ul class="menu"><li><a href=1>Home</a><li><a href=2>World</a></ul><div class="cookie-notice">We use cookies to make this site better. Please accept them.</div>
OPEN<h1>Big title</h1><p>First &eacute;l&eacute;ment of   the story is here,<br>and it goes on for a while, so that it is long.</p>
<div class="sidebar"><p>Related things that you may read, which is also a long text of many words here.</p></div><p>Short one.</p>
<form action=x><label>Name</label><button>Send it now</button></form><p>Last paragraph of the <b>st</b>ory is here. It ends now, finally, after many words.</p>CLOSE
<section class="comments"><h2>Comments</h2><p>I really liked this article, it was so good that I read it twice. Thanks to all.</p></section>
<script>var t="</p>";</script><footer>&copy; 2020 Site</footer></body></html>"""
TEXT = (
    "Big title First élément of the story is here, and it goes on for a while, so that it is long. Short one. "
    "Last paragraph of the story is here. It ends now, finally, after many words."
)


def extracted(spark, pages, field):
    return [r[0] for r in spark.createDataFrame([(p,) for p in pages], "html string").select(html_crf.main_text(F.col("html"), field)).collect()]


def test_main_text_of_several_layouts(spark, tables):
    field = html_crf.train(spark.read.parquet(f"{tables}/pages.parquet"))
    layouts = [("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ("<div>", "</div>")]
    pages = [PAGE.replace("OPEN", a).replace("CLOSE", b) for a, b in layouts]
    assert extracted(spark, pages, field) == [TEXT] * len(layouts)


def test_words_of_layouts_and_other_languages(spark, tables):
    """Marks above an article do not empty it, words that name a column or a topic do not cut it, ads and comments go in four languages."""
    field = html_crf.train(spark.read.parquet(f"{tables}/pages.parquet"))
    one = "The first paragraph of the story is here, with enough words to be one of them."
    two = "The second paragraph goes on for a while, and it ends where the story ends."
    other = "This text is long enough to look like a part of the story, but it is not one."
    story = f"<h1>Big title</h1><p>{one}</p><p>{two}</p>"
    top, end = "<body><nav><a href=1>Home</a> <a href=2>World</a></nav>", "<footer>&copy; 2020 Site</footer></body>"
    pages = [
        f'<div class="text-widget widget"><article>{story}</article></div>',
        f'<article><h1>Big title</h1><div class="column main-column"><p>{one}</p><p>{two}</p></div></article>',
        f'<article class="post tag-politics social featured">{story}</article>',
        f'<div id="more-text"><main class="form-page"><div class="tags-text">{story}</div></main></div>',
        f'<article><h1>Big title</h1><p>{one}</p><div class="werbung"><p>{other}</p></div><p>{two}</p></article>',
        f'<article><h1>Big title</h1><p>{one}</p><div class="publicité"><p>{other}</p></div><p>{two}</p></article>',
        f'<div>{story}</div><div class="kommentare"><p>{other}</p></div>',
        f'<div>{story}</div><section id="comentarios"><article class="comentario"><p>{other}</p></article></section>',
        f'<main>{story}</main><aside><article><p>{other}</p></article></aside>',
        f'<div>{story}</div><div class="seitenleiste"><p>{other}</p></div>',
    ]
    assert extracted(spark, [top + p + end for p in pages], field) == [f"Big title {one} {two}"] * len(pages)


def test_odd_pages(spark):
    field = html_crf.fit([])
    pages = [None, "", " ", "<p>", "<script>x", "no tags at all, just a sentence that is rather long and plain.", "<article><p>a&amp;b &am <p>c<b>d</article>"]
    assert extracted(spark, pages, field)[:5] == [""] * 5
    assert extracted(spark, pages, field)[6] == "a&b &am cd"
    long = "<article>" + "<p>A paragraph of some words, as many pages have. " * 5_000 + "</article>"
    assert len(extracted(spark, [long, long], field)[1].split()) == 45_000


def test_open_head_and_embedded_elements():
    def texts(page):
        return [text for text, _ in html_crf.leaf_blocks(page)]

    assert texts("<html><head><title>T</title><meta charset=utf-8><body><p>one</p><p>two</p></body></html>") == ["one", "two"]
    assert texts("<html><head><title>T</title><script>x()</script><noscript>n</noscript><p>one<p>two") == ["one", "two"]
    assert texts("<head><title>T</title>plain<p>two") == ["plain", "two"]
    for tag in ("noscript", "svg", "iframe", "object", "canvas"):
        assert texts(f"<body><p>one</p><div><{tag} a=b></div><p>two</p></body>") == ["one", "two"]
        assert texts(f"<body><p>one</p><{tag} a=b><p>two</p><{tag}><p>three</p></{tag}><p>four</p></body>") == ["one", "two", "four"]
        assert texts(f"<body><p>one</p><div><{tag}><p>two</p></{tag}></div><p>three</p>") == ["one", "three"]
        assert texts(f"<{tag}><div>one<{tag}>two</div></{tag}><p>three") == ["three"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p>") == ["so x=1 holds"]
    assert texts("<body><template><p>no</p></template><p>one<script>x") == ["one"]


def test_training_uses_whole_pages(spark):
    words = "This part of the page has a sentence of quite some words, as articles do. "
    page = "<body>" + "<div class=nav><a href=x>go</a></div>" * 450 + f"<main>{'<p>' + words + '</p>'}</main>" * 3 + "</body>"
    field = html_crf.train(spark.createDataFrame([(page,)] * 5, "html string"))
    cut = html_crf.train(spark.createDataFrame([(page[: page.index("<main>")] + "<main></main>",)] * 5, "html string"))
    assert field.by_name["main"] != cut.by_name["main"]


def test_viterbi_is_the_best_labelling():
    import itertools

    field = html_crf.fit([])
    blocks = [features for _, features in html_crf.leaf_blocks(PAGE)][:9]
    moves = field.transitions

    def value(labels):
        emit = sum(sum(field.by_name[f] for f in b) for b, y in zip(blocks, labels) if y)
        return emit + sum(moves[a, b] for a, b in zip(labels, labels[1:]))

    best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
    assert [int(x) for x in field.decode(blocks)] == list(best)


def test_rotation_of_odd_turns(spark):
    rows = [
        ("a", 0, "system", "be kind", 1), ("a", 1, "ann", "hi", 2), ("a", 2, "bob", None, 3), ("a", 2, "ann", "again é", 4), ("a", 2, "ann", "again é", 4),
        (None, None, None, "lost", 5), ("b", 0, "system", "alone", 6), ("c", 1, "", "x" * 5_000, 7),
    ]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, name long")
    got = chat.rotate(turns).orderBy("conv_id", "perspective", "place").toPandas()
    assert set(zip(got["conv_id"].fillna("-"), got["perspective"])) == {("a", "ann"), ("a", "bob"), ("-", "unknown"), ("c", "unknown")}
    for (_, _), part in got.groupby(["conv_id", "perspective"], dropna=False):
        dialogue = "".join(part["segment"])
        for r in part.to_dict("records"):
            assert dialogue[r["first"] : r["past"]] == r["segment"]
            if r["role"] == "assistant":
                assert dialogue[int(r["loss_first"]) : int(r["loss_past"])] == r["segment"].split("\n", 1)[1][:-1]
    ann = got[(got["conv_id"] == "a") & (got["perspective"] == "ann")]
    assert ann["role"].tolist() == ["system", "assistant", "assistant", "assistant", "user"]
    assert ann["name"].tolist()[-1] == "bob"
