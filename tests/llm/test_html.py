from html import unescape

from ledgerloom.llm.html_crf import block_features, blocks, default_model, extract_pages, labelled_pages, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><div class="ad">Buy now.</div>
<article><h1>Title &amp; more</h1><p><b>First  line,
 with <i>markup</i>.<br><p>Second &lt;tag&gt; &#8364;5.</p><div class="advert">Buy again.</div><p>Ja.</p>
<section class="comments"><div class="comment"><p>I disagree.</p></div></section></article>
<footer>&copy; me</footer><noscript>off</noscript><!-- gone --><p class="cookie-notice">We use cookies.</p></body></html>"""


def test_one_page():
    assert main_text(PAGE, default_model()) == "Title & more\nFirst line, with markup.\nSecond <tag> €5.\nJa."


def test_held_out_layouts():
    model, wrong, total = default_model(), 0, 0
    for page in labelled_pages(seed=11, count=120):
        cut = blocks(page)
        labels = model.viterbi(block_features(cut))
        total += len(cut)
        wrong += sum(a != int(b[3]) for a, b in zip(labels, cut))
    assert total > 1000 and wrong <= 0.02 * total


def test_broken_markup_never_fails():
    model = default_model()
    for cut in range(0, len(PAGE), 7):
        main_text(PAGE[:cut], model)
    for html in ("<", "&am", "<article><p>x", "</p></p>text", "<!--", "<script>", "<p a='>'>y</p>", "<a>" * 50, "\x00<p>"):
        assert "<" not in main_text(html, model) or html == "<"


def test_only_scripts_and_the_like_are_raw():
    para = "<p>Plain words of the article go on here, line {}.</p>"
    for tag, text in (("math", "<mi>x</mi>=1"), ("object", "fallback words"), ("svg", "<text>drawn</text>"),
                      ("noscript", "shown"), ("iframe", "framed")):
        whole = "<article>" + "".join(map(para.format, range(4))) + f"<p>Inside <{tag}>{text}</{tag}> ends.</p></article>"
        words = text.replace("<mi>", "").replace("</mi>", "").replace("<text>", "").replace("</text>", "")
        assert f"Inside {words} ends." in main_text(whole, default_model()), tag
        opened = f"<article><p>First words of the article.</p><{tag}>" + "".join(map(para.format, range(4))) + "</article>"
        assert "line 3." in main_text(opened, default_model()), tag


def test_training_comments_mean_nothing_on_a_page():
    page = "<article><p>foo one<!--main-->bar and more words.</p><!--/main--><p>The second paragraph goes on.</p></article>"
    assert main_text(page, default_model()) == "foo onebar and more words.\nThe second paragraph goes on."


def test_quotes_count_only_behind_an_equals_sign():
    paras = ["First words of this article go here.", "Middle words of it go here.", "Say it's the last of them."]
    for tag in ("<p title=it's>", "<p data-x=a'b class=it\"s>", "<p '>", "<p title = 'a > b' x=\"y>z\">"):
        page = f"<article><p>{paras[0]}</p>{tag}{paras[1]}</p><p>{paras[2]}</p></article>"
        assert main_text(page, default_model()) == "\n".join(paras), tag
    # a quote that is never closed ends with its tag
    assert main_text(f"<article><p>{paras[0]}</p><p title='open>{paras[1]}</p></article>", default_model()) == "\n".join(paras[:2])
    assert main_text("<article><p>Words before it." + "<p a=\"b\"" * 5000, default_model()) == "Words before it."


def test_deep_pages_take_linear_time():
    import time
    model, took = default_model(), []
    for depth in (5_000, 50_000):
        page = "".join(f"<div><blockquote>line {i} of text.<li>x" for i in range(depth))
        start = time.process_time()
        assert main_text("<article>" + page, model).count("\n") >= depth
        took.append(time.process_time() - start)
    assert took[1] < 40 * took[0]
    assert len(blocks("<article>" + "<div>" * 100_000 + "end")) == 1


def test_pages_written_by_hand():
    """Real-world shapes, none from ``labelled_pages``."""
    body = ["The council met on Tuesday to discuss the new bridge.", "Two members voted against the plan, citing its cost.",
            "Work is due to start in spring and to last eight months."]
    pages = {
        "news": f"""<body><header class="site-header"><a href="/">Daily</a></header><nav class="main-nav"><ul><li><a href="/w">World</a>
<li><a href="/s">Sport</a></ul></nav><main id="content"><article><h1>Bridge approved</h1><p>{body[0]}</p><p>{body[1]}</p><p>{body[2]}</p>
</article></main><aside class="related"><h3>Related</h3><ul><li><a href="/x">Older story</a></ul></aside><footer>© Daily</footer></body>""",
        "blog": f"""<div id="navbar"><a href="/">Home</a> <a href="/about">About</a></div><div class="post"><h1>Bridge approved</h1>
<p>{body[0]}</p><div class="ad">Buy one, get one free.</div><p>{body[1]}</p><p>{body[2]}</p></div>
<div id="comments"><div class="comment"><p>Great news for us all.</p></div></div><div class="footer">© me</div>""",
    }
    for name, page in pages.items():
        assert main_text(page, default_model()) == "\n".join(["Bridge approved", *body]), name


def test_cut_references_stay_as_they_are():
    assert main_text("<article><p>rock &amp roll &am", default_model()) == unescape("rock &amp roll &am")


def test_table(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "v", PAGE), (1, "u", PAGE),
            (5, "w", "<article>" + "<p>line of text.</p>" * 20_000 + "</article>")]
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = extract_pages(frame).collect()
    assert len(got) == 6
    for r in got:
        assert r.n_chars == len(r.text)
    by = {(r.page_id, r.url): r.text for r in got}
    assert by[2, None] == "" and by[3, "u"] == "" and by[1, "u"] == by[None, "v"] != ""
    assert by[5, "w"].count("\n") == 19_999
    assert extract_pages(frame.limit(0)).collect() == []
