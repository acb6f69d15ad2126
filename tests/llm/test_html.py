import random
import time

import pytest

from credscope.llm import op09_html as op

PAGE = """<!DOCTYPE html><html><head><title>T, t, t, t</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href=/a>One, two, three</a></li></ul></nav>
<div class="cookie-notice">We use cookies, many cookies, all cookies.</div><!-- <p>ad</p> -->
<div class="ad">Buy, buy, buy this now.</div>
%s
<div id="comments"><p>First, a comment, by a reader, that is long, with commas, and more.</p></div>
<aside><p>Side, side, side.</p></aside><form><p>Name, please, here</p><input></form><footer>&copy; me, 2020, all rights</footer></body></html>"""


def test_article_with_unclosed_tags():
    got = op.main_text(PAGE % "<article><h1>Head &amp; all</h1><p><b>One,\n  two&nbsp;three.<br><p>Four &lt;five&gt;.</p><p>Six <a href=x>link</a>.</article>")
    assert got == "Head & all\nOne, two three.\nFour <five>.\nSix link."


def test_best_container_without_article():
    body = "<div id=page><div class=col><ul><li><a href=1>x</a><li><a href=2>y</a></ul></div><div class=body><h2>Title</h2><p>A long text, with commas, and words.</p><ul><li>item one<li>item two</ul><blockquote><p>Quoted, here.</p></blockquote><table><tr><td>c1<td>c2</table></div></div>"
    assert op.main_text(PAGE % body) == "Title\nA long text, with commas, and words.\nitem one\nitem two\nQuoted, here.\nc1\nc2"


def test_siblings_that_score_well():
    many = "".join(f"<p>Paragraph {i}, with commas, and text.</p>" for i in range(4))
    assert op.main_text(f"<body><div class=x>{many}</div><div class=y>{many}</div><div class=z><a href=1>only, links</a></div></body>").count("Paragraph") == 8


def test_wrappers_with_boilerplate_names():
    article = "<article><header class='entry-header'><h1>Head</h1></header><p>One, two.</p><div class=share>Share, it.</div></article>"
    for name in ("layout has-sidebar", "no-sidebar", "with-comments", "page sidebar", "content_menu header"):
        assert op.main_text(PAGE % f"<div class='{name}'>{article}</div>") == "Head\nOne, two."
    assert op.main_text("<body><form id=aspnetForm>" + PAGE % article + "</form></body>") == "Head\nOne, two."
    many = "".join(f"<p>Paragraph {i}, with commas, and text that goes on for a while, and on.</p>" for i in range(20))
    assert op.main_text(f"<body><form><div class='wrap sidebar'>{many}<div class=comments><p>A comment, here.</p></div></div></form></body>").count("\n") == 19
    comment = "<div id=comments><article class=comment><p>" + "Long, long comment. " * 30 + "</p></article><article><p>Reply, too.</p></article></div>"
    assert op.main_text(PAGE % f"<div class='layout sidebar'>{article}{comment}</div>") == "Head\nOne, two."


def test_odd_pages():
    assert op.main_text("") == "" and op.main_text("<p>") == "" and op.main_text("<!-- open <p>x") == ""
    assert op.main_text("plain, text\nhere") == "plain, text here"
    assert op.main_text("a < b and <b>c</b> <3") == "a < b and c <3"
    assert op.main_text('<p>x</p><a href="open>y</a><p>z</p>').startswith("x")
    assert op.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert len(op.main_text("<article><p>" + "word, " * 200_000 + "</p></article>")) == 200_000 * 6 - 1


N = 100_000


@pytest.mark.parametrize("page", [
    "<div>word, word " * N, "<div>" * N + "</p></span>" * N + "x", "<b>" * N + "<li>a, b" * N, "<div>a, " * N + "</div>b" * N,
    "<b>" * N + "<p>x" * N, '<a ">"' * N + "'", "<a><section>" * N + "x",
], ids=["open", "unmatched", "items in inline", "nested", "paragraphs in inline", "open quote", "links around"])
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    assert op.main_text(page)
    assert time.process_time() - began < 5 * 3  # about 2 s; slow machines are allowed for, quadratic time is not


def _tree(rng, depth=0):
    """(tag, children): blocks hold (text, whether linked) parts, containers hold nodes."""
    if depth > 5 or rng.random() < 0.35:
        parts = [(" ".join(rng.choice(["one,", "two", "three,", "four" * 9]) for _ in range(rng.randint(1, 25))), rng.random() < 0.2) for _ in range(rng.randint(1, 3))]
        return rng.choice(["p", "li", "h2"]), parts
    return rng.choice(["div", "section", "article", "blockquote", "div"]), [_tree(rng, depth + 1) for _ in range(rng.randint(1, 4))]


def _written(node):
    tag, inner = node
    if tag in ("p", "li", "h2"):
        return f"<{tag}>" + " ".join(f"<a href=x>{t}</a>" if link else t for t, link in inner) + f"</{tag}>"
    return f"<{tag}>" + "".join(map(_written, inner)) + f"</{tag}>"


def _by_definition(top):
    """The article of a tree without boilerplate, every score by walks to the root."""
    blocks, up, tags = [], {}, {}

    def visit(node, path):
        me = (*path, len(up))
        up[me], tags[me] = path, node[0]
        if node[0] in ("p", "li", "h2"):
            blocks.append((me, " ".join(t for t, _ in node[1]), sum(len(t) for t, link in node[1] if link)))
        else:
            for child in node[1]:
                visit(child, me)

    tags[()] = ""
    visit(top, ())
    chain = lambda n: [n[:i] for i in range(len(n), -1, -1)]
    points, chars, linked = {}, {}, {}
    for me, text, of_links in blocks:
        for level, n in enumerate(chain(me)[1:]):
            points[n] = points.get(n, 0.0) + ((1 + text.count(",") + min(len(text) / 100, 3)) * (1 - of_links / len(text)) / (1, 2, 6, 9)[level] if level < 4 else 0)
            chars[n], linked[n] = chars.get(n, 0) + len(text), linked.get(n, 0) + of_links
    value = lambda n: points[n] * (1 - linked[n] / chars[n]) * (1.5 if tags[n] == "article" else 1) if n in chars else 0.0
    best = max(points, key=value)  # the first that a block reaches, as dicts keep their order
    while tags[best] == "blockquote":
        best = best[:-1]
    best = next((n for n in chain(best)[1:] if tags[n] == "article"), best)
    out = []
    for me, text, of_links in blocks:
        beside = next((n for n in chain(me) if best and n and n[:-1] == best[:-1]), None)
        kept = best in chain(me)
        if not kept and beside is not None:
            kept = value(beside) >= max(1.0, 0.2 * value(best)) or tags[beside] == "h2" or (tags[beside] == "p" and of_links < 0.25 * len(text) and len(text) > 80)
        if kept:
            out.append(text)
    return "\n".join(out)


def test_scores_by_definition():
    rng = random.Random(9)
    partly = 0
    for _ in range(600):
        top = ("body", [_tree(rng) for _ in range(rng.randint(1, 5))])
        want = _by_definition(top)
        assert op.main_text(_written(top)) == want
        partly += 0 < want.count("\n") + 1 < _written(top).count("<p>") + _written(top).count("<li>") + _written(top).count("<h2>")
    assert partly > 100


def test_table(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", PAGE % "<article><p>é \U0001f600</p></article>", "q"), (2, None, None, "q"), (None, "v", "", None), (3, "u", "<p>a</p>", ""), (3, "u", "<p>a</p>", "")]
    got = op.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "é \U0001f600", 3), ("2", "", 0), ("3", "a", 1), ("3", "a", 1), ("None", "", 0)]
    assert op.extract(spark.createDataFrame([], schema)).collect() == []
