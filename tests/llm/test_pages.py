import json

from claimloom.llm import wrappers

FRAME = (
    '<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var a="</p><article>";</script></head>'
    "<body><nav><ul><li><a href=/a>menu {i}</a></li><li>two</li></ul></nav><div class='ad box'>buy {i}</div>{main}"
    "<aside>side</aside><div id=comments><p>reader {i}</p></div><form>mail <input></form><footer>foot {i}</footer>"
)


def test_blocks_of_broken_html():
    page = "<article><h1>A &amp;amp; b</h1><p><b>one\n two<br>three<p>fo<i>u</i>r<!-- <p>x --><ul><li>a<li>b</ul>t&nbsp;z"
    blocks, expression = wrappers.blocks_of(page)
    assert [t for _, t in blocks] == ["A &amp; b", "one two three", "four", "a", "b", "t z"]
    article = expression[0]
    assert [x[:2] for x in article[2]] == [["h1", "1"], ["p", "+"], ["ul", "1"], ["#", "1"]]
    assert article[2][2][2] == [["li", "+", [["#", "1", []]]]]


def test_alignment_stays_union_free():
    a = wrappers.blocks_of("<div><h2>x</h2><p>1</p><h2>y</h2><p>2</p></div>")[1]
    b = wrappers.blocks_of("<div><h2>x</h2><p>1</p><h2>y</h2><p>2</p><h2>z</h2><p>2</p><ul><li>q</ul></div>")[1]
    both = wrappers.align(a, b)
    assert [x[:2] for x in both[0][2]] == [["()", "+"], ["ul", "?"]]
    assert wrappers.align(both, a) == both and wrappers.align(b, both) == both
    assert wrappers.align([], a)[0][1] == "?"


def test_main_text_of_hosts(spark):
    main = "<article><h1>Title {i}</h1><p>body {i}</p><p>same on all</p></article>"
    plain = "<div><p>text {i}</p><p>more &lt;{i}&gt;</p></div>"
    rows = [(i, f"http://A.net/{i}", FRAME.format(i=i, main=main.format(i=i))) for i in range(6)]
    rows += [(10 + i, f"http://b.net/{i}", FRAME.format(i=i, main=plain.format(i=i))) for i in range(4)]
    rows += [(20, "http://c.net/", FRAME.format(i=1, main=plain.format(i=1))), (21, None, "<p>bare"), (22, "x", None)]
    rows += [(23, "http://a.net/x", "<body><p>no article here</p>"), (24, "http://d.net", ""), (25, "http://d.net", "<p>")]
    rows += [rows[0], (None, "http://a.net/q", rows[0][2]), (30, "http://e.net", "<article><p>" + "w " * 200_000)]
    rows += [(31, "http://e.net", "<div>" * 3000 + "deep" + "</div>" * 3000), (32, "http://e.net", '<a href="' * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    found = wrappers.extract(pages.selectExpr("*", "'x' AS text", "1 AS host", "2 AS slots")).collect()
    assert len(found) == len(rows)
    text = {r.page_id: r.text for r in found}
    assert all(r.n_chars == len(r.text) for r in found)
    for i in range(6):
        assert text[i] == f"Title {i}\nbody {i}\nsame on all"
    assert text[None] == text[0] and sum(r.page_id == 0 for r in found) == 2
    for i in range(4):
        assert text[10 + i] == f"text {i}\nmore <{i}>"
    assert (text[20], text[21], text[22], text[24], text[25]) == ("text 1\nmore <1>", "bare", "", "", "")
    assert text[23] == "no article here"
    assert text[30] == ("w " * 200_000).strip() and text[31] == "deep"
    assert wrappers.extract(pages.limit(0)).count() == 0
    hosts = {r.host: json.loads(r.wrapper) for r in wrappers.infer(pages).collect()}
    assert hosts["a.net"]["pages"] == 9 and hosts["b.net"]["pages"] == 4


def test_partial_wrappers_agree():
    pages = ["<div><p>a</p></div>", "<div><p>a</p><p>b</p></div><ul><li>x</ul>", "<div></div>", "<div><h2>t</h2><p>a</div>"]
    one = wrappers.Wrapper()
    for page in pages:
        one.add_page(page)
    left, right = wrappers.Wrapper(), wrappers.Wrapper()
    for page in pages[:2]:
        left.add_page(page)
    for page in pages[2:]:
        right.add_page(page)
    left.merge(wrappers.Wrapper.read(right.write()))
    assert (left.expression, left.slots, left.pages) == (one.expression, one.slots, one.pages)


def test_text_after_elements_left_out():
    def texts(page):
        return [text for _, text in wrappers.blocks_of(page)[0]]

    assert texts('<article><p>one</p><svg class="i"/><p>two</p><p>three</p></article>') == ["one", "two", "three"]
    assert texts("<article><template-x>a</template-x><select-list><p>two</p></article>") == ["a", "two"]
    unclosed = "<article><p>one</p><button>share<p>two</p><object data=x><p>three</p><select><option>q<p>four</p></article>"
    assert texts(unclosed) == ["one", "two", "three", "four"]
    within = "<p>a <svg><title>icon</title><path/></svg> b <button><div>x</div>y</button> c</p><svg><p>d"
    assert texts(within) == ["a b c", "d"]
    inert = "<div><article><noscript><div></noscript><p>x</p><noscript></div></noscript><p>y</p></article></div>"
    assert [path.split("/")[2] for path, _ in wrappers.blocks_of(inert)[0]] == ["article", "article"]
    assert texts("<p>a<script>x</scripty></script>b<style>c") == ["ab"]


def test_text_after_deep_elements():
    deep = "<div>" * 130 + "deep" + "</div>" * 130
    blocks, _ = wrappers.blocks_of(f"<div><article><p>a</p>{deep}<p>b</p></article><p>out</p></div>")
    assert [text for _, text in blocks] == ["a", "deep", "b", "out"]
    assert ["article" in path.split("/") for path, _ in blocks] == [True, True, True, False]
    inner = "<nav>menu</nav><article><ul><li>x<li>y</ul></article>"
    blocks, _ = wrappers.blocks_of("<div>" * 3000 + inner + "</div>" * 3000 + "<p>end")
    assert [(path.split("/")[-1], text) for path, text in blocks] == [
        ("-nav", "menu"), ("article", "x"), ("article", "y"), ("p", "end"),
    ]
    page = "<ul><li>" + "<div>" * 100_000 + "<li>" + "</section>" * 100_000
    assert wrappers.blocks_of(page)[0] == []


def test_slots_are_compared_whole(spark):
    lead = "terms " * 100
    page = "<body><h1>title {i}</h1><div><p>" + lead + "</p><p>body {i}</p></div></body>"
    rows = [(i, f"http://lead.net/{i}", page.format(i=i)) for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert all(text[i].endswith(f"\nbody {i}") for i in range(4))


def test_one_page_with_main_leaves_the_others_of_its_host(spark):
    plain = "<body><div><p>the same on all pages</p></div><section><p>body {i}</p></section></body>"
    rows = [(i, f"http://mixed.net/{i}", plain.format(i=i)) for i in range(5)]
    rows += [(5, "http://mixed.net/m", "<body><div><p>another</p></div><main><p>own</p></main></body>")]
    rows += [(6, "http://mixed.net/e", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert text == {i: f"body {i}" for i in range(5)} | {5: "own", 6: ""}


def test_expression_slots_decide(spark):
    page = "<div><p>constant notice</p><h2>head {i}</h2><p>body {i}</p></div>"
    groups = "<div><p>intro</p><section><h2>a {i}</h2><ul><li>x</ul><h2>b</h2><ul><li>y {i}</ul></section>{more}</div>"
    rows = [(i, f"http://plain.net/{i}", page.format(i=i)) for i in range(6)]
    more = ["", "<table><tr><td>cell</table>"]
    rows += [(10 + i, f"http://groups.net/{i}", groups.format(i=i, more=more[i % 2])) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    text = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    for i in range(6):
        assert text[i] == f"head {i}\nbody {i}"
        assert text[10 + i] == f"a {i}\nx\nb\ny {i}" + ("\ncell" if i % 2 else "")


def test_pages_are_matched_against_their_expression():
    shapes = ["<h2>a</h2><p>b</p>", "<h2>a</h2><p>b</p><h2>c</h2><p>d</p>", "<p>a</p><ul><li>b<li>c</ul>t<p>d</p>", "<p>a"]
    one = wrappers.Wrapper()
    for shape in shapes:
        one.add_page(f"<div>{shape}</div>")
    for shape in shapes:
        blocks, tree = wrappers.blocks_of(f"<div>{shape}</div>", folded=False)
        slots = wrappers.Slots(one.expression).of(tree)
        assert sorted(slots) == list(range(len(blocks)))
    level = wrappers.Slots([["p", "1", []], ["()", "+", [["h2", "1", []], ["p", "?", []]]], ["p", "?", []]])._top
    assert level.places(("p", "h2", "p", "h2", "p")) == [0, 1, 2, 1, 2]
    assert level.places(("ul", "h2")) == [None, 1]


def extracted(spark, pages):
    """Texts of one host's pages, in their order, wherever its rows lie."""
    rows = [(i, f"http://trial.net/{i}", page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = [
        [r.text for r in sorted(wrappers.extract(df.repartition(n)).collect(), key=lambda r: r.page_id)] for n in (1, 7)
    ]
    assert found[0] == found[1]
    return found[0]


def test_constant_text_beside_changing_text_of_one_slot(spark):
    body = lambda i: "".join(f"<p>body {i} {k}</p>" for k in range(1 + i % 5))
    closing = [f"<body><div>{body(i)}<p>Follow us for more</p></div></body>" for i in range(40)]
    foot = [f"<body><div>body {i}</div><div><p>constant foot</p></div></body>" for i in range(40)]
    lead = [f"<body><div><p>{'the lead of all' if i else 'no lead'}</p><p>body {i}</p></div></body>" for i in range(40)]
    assert extracted(spark, closing) == ["\n".join(f"body {i} {k}" for k in range(1 + i % 5)) for i in range(40)]
    assert extracted(spark, foot) == [f"body {i}" for i in range(40)]
    assert extracted(spark, lead) == ["no lead\nbody 0"] + [f"body {i}" for i in range(1, 40)]


def test_agreement_of_two_pages_and_copies_prove_nothing(spark):
    two = ["<body><h1>Title</h1><p>first paragraph</p><p>only here</p></body>", "<body><h1>Title</h1><p>first paragraph</p></body>"]
    assert extracted(spark, two) == ["Title\nfirst paragraph\nonly here", "Title\nfirst paragraph"]
    assert extracted(spark, ["<body><p>the same page</p></body>"] * 9) == ["the same page"] * 9
    half = [f"<body><p>{'half of them' if i % 2 else f'page {i}'}</p><p>body {i}</p></body>" for i in range(8)]
    assert extracted(spark, half)[1] == "half of them\nbody 1"


def test_slots_of_the_expression_tell_main_text_on_pages_with_article():
    pages = ["<article><h1>a</h1><p>b</p></article><div><p>c</p></div>", "<div><p>d</p></div><footer>e</footer>"]
    one = wrappers.Wrapper()
    for page in pages:
        one.add_page(page)
    slots = wrappers.Slots(one.expression)
    assert sorted(slots.kinds) == ["main", "main", "never", "open"]
    assert [wrappers.main_text(page, slots) for page in pages] == ["a\nb", "d"]
    # The labels of the slots count, not the page: in another expression the same page reads otherwise.
    other = wrappers.Slots(json.loads(json.dumps(one.expression).replace("article", "-aside")))
    _, tree = wrappers.blocks_of(pages[0], folded=False)
    assert other.of(tree) != slots.of(tree)


def test_a_host_of_many_shapes(spark):
    tags = ["p", "h2", "ul", "table", "pre", "blockquote", "dl", "section", "h3"]
    shapes = ["".join(f"<{tags[(i >> 3 * k) % 8]}>t{i} {k}</{tags[(i >> 3 * k) % 8]}>" for k in range(3)) for i in range(500)]
    pages = [f"<body><div>{shape}</div><div><h4>shown everywhere</h4></div></body>" for shape in shapes]
    assert extracted(spark, pages) == ["\n".join(f"t{i} {k}" for k in range(3)) for i in range(500)]
