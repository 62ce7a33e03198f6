import pyarrow.parquet as pq
from brute import DATA, article

from ledgerloom.llm import pages

SCHEMA = "page_id long, url string, html string, key string, host string, text string"


def extract(llm, rows):
    table = llm.createDataFrame([(i, u, h, None, "x", None) for i, u, h in rows], SCHEMA)
    return {r["page_id"]: r for r in pages.extract(table).collect()}


def text_of(source):
    return pages.main_text(pages.blocks_of(source))


def test_article_without_frame():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li>Home</li></ul></nav><div class="cookie-notice">We use cookies</div>
    <article><header><h1>The &amp; title</h1></header><p>First   para&nbsp;graph<br>goes <b>on</b>.<p>Second &lt;p&gt; one
    <aside>Aside</aside><form><p>Name</p><button>Go</button></form><div class="ad">Buy</div><p>Last</p>
    <section id="comments"><article class="comment"><p>First!</p></article></section></article>
    <div class="sidebar"><p>Side</p></div><!-- <p>no</p> --><footer>&copy;</footer></body></html>"""
    assert text_of(page) == "The & title\nFirst para graph goes on.\nSecond <p> one\nLast"


def test_lists_tables_and_open_elements():
    page = "<main><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><pre>x\n y</pre></main>"
    assert text_of(page) == "one\ntwo\na\nb\nx y"


def test_broken_pages():
    for page in (None, "", "<", "<article", "<article><p>a", "<p class='x>a</p>", "<script>", "<!-- x", "</p></p>", "<article><svg/>a</article>"):
        pages.blocks_of(page)
    assert text_of("<article><p>a") == "a" and text_of("<article>" + "<div>" * 3000 + "deep") == "deep"
    assert len(text_of("<article>" + "<p>word</p>" * 20_000)) == 5 * 20_000 - 1


def test_attribute_values_of_any_length():
    data = "data:image/png;base64," + "A>b/" * 25_000
    assert text_of(f"<article><p>a <img src=\"{data}\">b <img src='{data}' alt=x>c</p></article>") == "a b c"
    assert text_of(f'<nav data-x="{data}"><p>Menu</p></nav><article data-x="{data}"><p>a</p></article><p>b</p>') == "a"


def test_names_that_hold_a_frame_word_among_others_stay():
    kept = ['section id="side-effects"', 'h2 id="related-work"', 'div id="search-algorithms"', 'p class="share-price"', 'section id="social-security"', 'h3 id="search"', 'div class="cookie-recipes"', 'div id="social-media"']
    page = "<article>" + "".join(f"<{k}>text {i}</{k.split()[0]}>" for i, k in enumerate(kept)) + "</article>"
    assert text_of(page) == "\n".join(f"text {i}" for i in range(len(kept)))
    gone = ['div class="share-buttons"', 'div id="related-posts"', 'ul class="x main-nav"', 'div class="cookieBanner"', 'div class="widget__title"', 'div class="ad-300"', 'p class="newsletter"', 'div class="social-links"', 'div id="comments"', 'div class="ad--large"']
    for name in ("commentary", "road", "download-list"):
        assert text_of(f'<article class="{name}"><p>a</p></article>') == "a"
    for k in gone:
        assert text_of(f"<article><{k}>x</{k.split()[0]}><p>a</p></article>") == "a", k


def test_forms_and_open_menus_around_the_article():
    article = "<article><p>The text</p><form><p>Your name</p></form></article>"
    assert text_of(f"<body><form id=aspnet><p>Menu</p>{article}<p>End</p></form></body>") == "The text"
    assert text_of(f"<fieldset><div>{article}</div></fieldset>") == "The text"
    for tag in ("nav", "header", "menu"):
        assert text_of(f"<{tag}><ul><li>Home</ul>{article}<footer><p>End</p></footer>") == "The text", tag
    # a teaser in a menu is frame where an article lies outside, and so is one in an aside
    assert text_of(f"<nav><article><p>Teaser</p></article></nav>{article}") == "The text"
    assert text_of("<aside><form><article><p>Teaser</p></article></form></aside><p>a</p>") == ""
    # a wrapper by its class stays frame
    assert text_of(f'<form class="login">{article}</form>') == "The text" and text_of(f'<div class="sidebar">{article}</div>') == ""


def test_main_counts_only_without_article():
    assert text_of("<main><p>Related: x y z</p><article><p>a</p></article><p>More</p></main>") == "a"
    assert text_of("<main><p>a</p><section id=comments><article class=comment><p>b</p></article></section></main>") == "a"
    assert text_of("<div role=main><p>a</p></div><div><p>b</p></div>") == "a"


def test_formulas_and_fallbacks():
    formula = '<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding="application/x-tex">x=1</annotation></semantics></math>'
    assert text_of(f"<article><p>So {formula} holds</p></article>") == "So x=1 holds"
    assert text_of("<article><object data=a.swf><param name=q><p>A table</p></object><p>b<noscript>Turn scripts on</noscript><iframe>old</iframe></p></article>") == "A table\nb"


def test_repeated_runs_go_where_no_article_is(llm):
    frame, end = "<div>Read our free weekly letter now</div>", "<div>All rights of this site reserved</div>"
    rows = [(i, f"http://h.org/{i}", f"<body>{frame}<div>{i * 7 + 1} stories that only page {i} tells</div>{end}</body>") for i in range(6)]
    rows += [(10, "http://other.org/", f"<body>{frame}<p>alone here</p></body>"), (11, None, None), (12, "http://[bad", "<p>x</p>"), (None, "http://h.org/n", "")]
    rows += [(13, "http://a.org/1", "<article><p>Read our free weekly letter now</p></article>"), (14, "http://a.org/2", "<article><p>Read our free weekly letter now</p></article>")]
    rows += [rows[0]]
    got = extract(llm, rows)
    assert [got[i]["text"] for i in range(6)] == [f"{i * 7 + 1} stories that only page {i} tells" for i in range(6)]
    assert got[10]["text"] == "Read our free weekly letter now\nalone here" and got[11]["text"] == "" and got[None]["n_chars"] == 0
    assert got[13]["text"] == got[14]["text"] == "Read our free weekly letter now"


def test_long_repeats_go_wherever_they_begin_and_unique_words_stay(llm):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    cookies, start, inner = words("cookie", 40), words("start", 16), words("inner", 20)
    body = "<body><div>{c}</div><div>{s} {a}</div><div>{t} {b}</div><div>{d} {i} {e}</div><div>{f} {l}</div></body>"
    rows, expected = [], {}
    for k in range(3):
        a, b, d, e = words(f"a{k}-", 6), words(f"b{k}-", 4), words(f"d{k}-", 5), words(f"e{k}-", 3)
        f, l = words("first", 5), words(f"l{k}-", 30)
        rows.append((k, f"http://h.org/{k}", body.format(c=cookies, s=start, a=a, t=words("t", 4), b=b, d=d, i=inner, e=e, f=f, l=l)))
        expected[k] = f"{a}\n{b}\n{d} {e}\n{f} {l}"
    rows.append((9, "http://other.org/", f"<body><div>{cookies}</div></body>"))
    rows.append(rows[-1])
    got = extract(llm, rows)
    assert {k: got[k]["text"] for k in expected} == expected
    assert got[9]["text"] == cookies and got[9]["n_repeated"] == 0
    assert [got[k]["n_repeated"] for k in range(3)] == [40 + 16 + 4 + 20 + 5] * 3


def test_the_host_decides_where_structure_is_in_doubt(llm):
    notice, end = "We set cookies to count our readers", "All rights of this site reserved"
    body = (
        "<body><nav><p>Home</p></nav><main><h1>Title {k}</h1><p>Read our free weekly letter now</p><article><p>one {k}</p><p class=notice>{n}</p>"
        "<p class=side>By the way {k} is odd</p><p>two {k}</p><div class=footer-1><p>Sources of {k}</p><p>{e}</p></div><div class=ad>Buy {k}</div></article>"
        "<div class=footer>Foot {k}</div></main><p>Outside {k}</p></body>"
    )
    rows = [(k, f"http://h.org/{k}", body.format(k=k * 7, n=notice, e=end)) for k in range(3)]
    rows += [(8, "http://main.org/", f"<main><p>a</p><p class=notice>{notice}</p></main>"), (9, "http://main.org/9", "<main><p>a</p><p class=notice>b</p></main>")]
    rows += [(10, "http://main.org/10", f"<div class=x>{notice}</div>")]
    got = extract(llm, rows)
    for k in range(3):
        assert got[k]["text"] == "\n".join(t.format(k * 7) for t in ("Title {}", "one {}", "By the way {} is odd", "two {}", "Sources of {}"))
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[8]["text"] == "a" and got[9]["text"] == "a\nb"


def test_suffix_array_finds_the_longest_run_on_another_page():
    import pandas as pd

    token = lambda *x: b"".join(int(t).to_bytes(4, "big") for t in x)
    rows = [("h", 1, token(1, 2, 3, 4, 5), 4, 7, 7), ("h", 1, token(1, 2, 3, 4, 9), 4, 7, 7), ("h", 1, token(1, 2, 3, 8, 8), 2, 5, 5), ("h", 2, token(2, 1), 2, 7, 7)]
    frame = pd.DataFrame(sorted(rows), columns=["host", "shard", "tokens", "own", "low", "high"])
    out = pd.concat(pages._repeated(iter([frame])))
    assert sorted(out["run"].tolist()) == [3]


def test_empty_table(llm):
    assert extract(llm, []) == {}


def test_query(ask):
    table = pq.read_table(DATA / "pages.parquet").to_pandas()
    got = ask("op4_html_text").set_index("page_id")
    assert len(got) == len(table)
    for i, source in zip(table.page_id, table.html):
        assert got.loc[i].text == article(source) and got.loc[i].n_chars == len(article(source))
