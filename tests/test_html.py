"""Trees of pages with tags that nobody closed."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.operators import extract as X
from ledgerwatch.operators.html import Node, Tree


def shape(node):
    return [k.strip() if isinstance(k, str) else (k.tag, shape(k)) for k in node.kids if not isinstance(k, str) or k.strip()]


def test_implied_ends():
    same = [
        ("<table><tr><td>a<td>b<tr><td>c</table>", "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"),
        ("<table><thead><tr><th>h<tbody><tr><td>x<tbody><tr><td>y</table>z", "<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>x</td></tr></tbody><tbody><tr><td>y</td></tr></tbody></table>z"),
        ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>"),
        ("<p>a<p>b<div>c</div>", "<p>a</p><p>b</p><div>c</div>"),
        ("<select><option>a<option>b<optgroup><option>c</select>", "<select><option>a</option><option>b</option><optgroup><option>c</option></optgroup></select>"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
        ("<table><tr><td><span>a<td>b</table>", "<table><tr><td><span>a</span></td><td>b</td></tr></table>"),
        ("<table><tr><td>a<table><tr><td>in</table>b<td>c</table>", "<table><tr><td>a<table><tr><td>in</td></tr></table>b</td><td>c</td></tr></table>"),
        ("<div><table><tr><td>a</div>b</td><td>c</table></div>d", "<div><table><tr><td>ab</td><td>c</td></tr></table></div>d"),
        ("<p>a<br>b<img>c</p></p></x>d", "<p>a<br/>b<img/>c</p>d"),
    ]
    for page, closed in same:
        joined = lambda page: [x for x in Tree(page).root.text("|").split("|")]
        if "</div>b" not in page:
            assert shape(Tree(page).root) == shape(Tree(closed).root), page
        else:
            assert "".join(joined(page)) == "".join(joined(closed)) and [n.tag for n in Tree(page).root.walk()] == [n.tag for n in Tree(closed).root.walk()]


TAGS = ["table", "tr", "td", "tbody", "ul", "li", "p", "div", "span", "option", "br"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS] + ["x"]), max_size=40))
def test_any_tags_give_a_tree(parts):
    tree = Tree("".join(parts))
    assert "".join(tree.root.text().split()) == "x" * parts.count("x")
    assert sum(1 for _ in tree.root.walk()) == sum(p[0] == "<" and p[1] != "/" for p in parts)
    for node in tree.root.walk():
        assert not (node.tag in ("li", "option", "tr", "td") and node.children(node.tag)), parts
        assert not (node.tag == "p" and (node.children("div") or node.children("table")))


def test_deep_pages_cost_the_same():
    for page in ("<div>" * 100_000 + "x", "<li><p>" * 100_000, "<p><button>" + "<div><p>" * 50_000, "<div>" * 50_000 + "</li></span>" * 50_000, "<table><tr><td>" * 40_000 + "</div>" * 40_000):
        began = time.perf_counter()
        root = Tree(page).root
        assert sum(1 for _ in root.walk()) and root.text() in ("", "x")
        assert time.perf_counter() - began < 20


def test_hidden_text():
    assert Tree("<td>a<script>if (x) y()</script><style>b</style><!-- c -->d</td>").root.text() == "ad"
    assert isinstance(Tree("").root, Node)


def test_bad_pages_have_an_error(spark, monkeypatch):
    good = "<table><tr class='ecl-table__row'><td><strong>Nombre de personnes (total)<td>7"
    pages = spark.createDataFrame([(1, good), (2, "<div>" * 100_000), (3, "<![x[ broken"), (4, None)], "n int, html string")
    got = {r.n: (r.people_involved, r.error) for r in X.extract_register_fields(pages).collect()}
    assert got[1] == (7, None) and got[2] == (None, None) and got[4] == (None, None)
    assert got[3] == (None, None) or got[3][1]
    head = f'<h2 id="{X.ANCHOR}">x</h2><table><thead><tr><th>a<tbody><tr><td>Doe<td>Jo<td>02/01/2024<tr><td>alone'
    monkeypatch.setitem(X.PAGE_KINDS, "accredited", (lambda root: 1 / 0 if root.all("bad") else X.accredited(root), X.PAGE_KINDS["accredited"][1]))
    rows = X.extract_accredited(spark.createDataFrame([(1, head), (2, "<bad>")], "n int, html string")).collect()
    assert sorted((r.n, r.surname, r.first_name, r.start_date, r.error) for r in rows) == [(1, "Doe", "Jo", "2024-01-02", None), (2, None, None, None, "ZeroDivisionError: division by zero")]
    monkeypatch.setitem(X.PAGE_KINDS, "search", (lambda root: 1 / 0 if root.all("bad") else X.search_results(root), X.PAGE_KINDS["search"][1]))
    rows = X.extract_search_results(spark.createDataFrame([(1, "<article class='ecl-content-item'><a class=ecl-link href='?id=5'><b class=ecl-link__label>N"), (2, "<bad>")], "n int, html string")).collect()
    assert sorted((r.n, r.id, r.name, r.error is None) for r in rows) == [(1, "5", "N", True), (2, None, None, False)]
