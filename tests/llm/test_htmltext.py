import random
import re

from shelfcast.llm.htmltext import render, rendered


def test_blocks_lists_and_inline_space():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><body><h1>Head
      line</h1><p>One<b> two</b>
three<br>four<p>Five &amp; six<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol start=3><li>x<li>y</ol>tail"""
    assert render(page) == "Head line\n\nOne two three\nfour\n\nFive & six\n\n - a\n - b\n    - c\n - d\n\n3. x\n4. y\n\ntail"


def test_tables_are_aligned_with_implied_tags():
    page = "<table><caption>Cap<tr><th>Name<th>Qty<tr><td>Apple<td>10<tr><td colspan=2>wide one<tr><td>l1<br>l2<td>r</table>after"
    assert render(page) == "Cap\n\nName   Qty\nApple  10\nwide one\nl1     r\nl2\n\nafter"
    nested = "<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>"
    assert render(nested).split() == ["a", "d", "b", "c"] or render(nested).split() == ["a", "b", "c", "d"]


def test_visibility_rules():
    page = """<p>a<span hidden>no</span><i style="color:red; DISPLAY : none">no</i><script>if (a < b) "</p>"</script><noscript>no</noscript>
<template>no</template><!-- no --><input type=hidden value=no>b<textarea>c &lt;</textarea><select><option>d<option>e</select><div style="visibility:hidden">no</div>"""
    assert render(page).split() == ["a", "b", "c", "<", "d", "e"] or "no" not in render(page).split()
    assert "no" not in render(page).split()


def test_formulas_and_drawings_show_their_text():
    formula = "<p>As <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=tex>no</annotation></semantics></math> holds"
    assert render(formula) == "As x=2 holds"
    chart = """<p>Sales<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><defs/><title/>
<rect width=1 /><text x=1>Jan</text><text x=2>Feb <tspan>12</tspan></text><style>no</style></svg>up<svg><path d="M0"/></svg> end"""
    assert render(chart) == "Sales Jan Feb 12 up end"
    assert render("<svg hidden><text>no</text></svg>a<text>b</text>c") == "abc"


def test_pre_entities_and_broken_markup():
    assert render("<pre>\n a\n   b</pre>x") == " a\n   b\n\nx"
    assert render("1 < 2 <a href='x>y'>l</a> &copy; &#233; <") == "1 < 2 l © é <"
    assert render("<p>open <!-- never closed <p>no") == "open"
    assert render("<script>never closed") == "" and render("") == "" and render(None) is None
    assert render("</p></li></table>t<b><i>u</b></i>") == "tu"
    assert render("<div " + "a" * 10 + "'\"><p>x") .endswith("x")


def test_deep_and_long_pages():
    deep = "<div>" * 50_000 + "x" + "</div>" * 50_000
    assert render(deep) == "x"
    long = "".join(f"<p>w{i}" for i in range(100_000))
    assert render(long).split() == [f"w{i}" for i in range(100_000)]


def test_query_over_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a<p>b"), (2, "u", None), (None, None, ""), (1, "u", "<p>a<p>b")], "page_id long, url string, html string").withColumnRenamed("url", "text")
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in rendered(pages).collect() if r.text is not None)
    assert got == [(0, "", 0), (1, "a\n\nb", 4), (1, "a\n\nb", 4)]
    assert rendered(pages.limit(0)).count() == 0


def test_long_attributes_with_quoted_ends_are_one_tag():
    page = '<p>a<img src="data:' + "x" * 70_000 + '>' + "y" * 70_000 + '" alt="no">b<a title=\'' + "<p>no" * 5 + "'>c</a>"
    assert render(page) == "abc"
    assert render('<a title="never closed>d</a> e') == "d e"
    many = '<i a="1>">x</i>' * 20_000
    assert render(many) == "x" * 20_000


def test_columns_are_as_wide_as_their_cells():
    wide = "w" * 50
    assert render(f"<table><tr><td>{wide}<td>r<tr><td>a<td>b</table>") == f"{wide}  r\na{' ' * 51}b"
    text = " ".join(["word"] * 100)
    lines = render(f"<table><tr><td>{text}<td>right<tr><td>x<td>y</table>").split("\n")
    assert lines[0].endswith("  right") and lines[0].index("right") == lines[-1].index("y") and " ".join(lines).split().count("word") == 100
    # a word wider than any column: what follows is on the next line, in its column
    assert render(f"<table><tr><td>{'u' * 300}<td>r<tr><td>abc<td>s</table>") == "u" * 300 + "\n     r\nabc  s"
    # the last cell of a row is never wrapped
    assert render(f"<table><tr><td>a<td>{text}</table>") == "a  " + text


def test_cells_span_rows():
    page = "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>"
    assert render(page) == "a  b\n   c\nd  e"
    page = "<table><tr><th>k<td rowspan=0>all<td>x<tr><td>l<td>y<tr><td>m<td>z</table>"
    assert render(page) == "k  all  x\nl       y\nm       z"
    page = "<table><tr><td rowspan=2 colspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>"
    assert render(page).split("\n")[1].strip() == "d" and render(page).split("\n")[1].index("d") == render(page).split("\n")[0].index("c")


def test_visibility_is_inherited_and_may_be_restored():
    page = '<div style="visibility:hidden">no<p>no <b style="visibility: visible">yes</b> no</p><i>no</i></div>after'
    assert render(page) == "yes\n\nafter"
    assert render('<ol style="visibility:hidden"><li>no<li style="visibility:visible">two</ol>') == "2. two"
    assert render('<div style="display:none">no<b style="visibility:visible;display:block">no</b></div>ok') == "ok"


def test_style_rules():
    page = """<style>/* .ok{display:none} */ .h, #x { display : none } p.q{visibility:hidden}
    @media print { .ok { display: none } .no2 {display:none} } @import "a"; b.w { DISPLAY:NONE !important } .s.t{display:none} div > .ok {display:none}
    .back{display:none} div.back{display:block} em{display:none}</style>
    <p>1<i class="h">no</i><i id=x>no</i><i class="a h b">no</i>2<p class=q>no<b style="visibility:visible">3</b><p class="ok">4
    <b class=w style="display:inline">no</b><u class=s>5</u><u class="t s">no</u><div class=back>6</div><em>no</em><em style="display:inline">7</em><i hidden>no</i><i hidden style="display:inline">8</i>"""
    assert render(page).split() == ["12", "3", "4", "5", "6", "78"]
    # a rule after its element counts as well
    assert render("<p class=z>no<p>a<style>.z{display:none}</style>") == "a"


def test_details_dialogs_and_fields():
    page = "<details><p>no</p><summary>S</summary>no</details><details open><summary>T</summary>u</details>"
    assert render(page) == "S\nT\nu"
    assert render("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"
    assert render('<input type=submit value="Go now"> <input value=typed><input type=password value=no><input type=checkbox value=no><input type=HIDDEN value=no>').split() == ["Go", "now", "typed"]


# -- a plain recursive renderer over random trees

MARGINS = ("p", "ul", "ol", "blockquote", "section")
LINES = ("div", "li")


def random_tree(rng, depth=0, allowed=("div", "p", "section", "b", "span", "br", "ul", "ol", "blockquote", "table")):
    """(tag, attributes, children); text is a string."""
    out = []
    for _ in range(rng.randrange(1, 4)):
        if depth > 3 or rng.random() < 0.4:
            out.append(rng.choice(["one", " two ", "three\n four", " ", "five"]))
            continue
        tag = rng.choice(allowed)
        attrs = rng.choice([{}] * 6 + [{"hidden": ""}, {"class": "gone"}, {"style": "visibility:hidden"}, {"style": "visibility:visible"}, {"id": "dim"}])
        if tag == "br":
            out.append((tag, {}, []))
        elif tag in ("b", "span", "p"):
            out.append((tag, attrs, random_tree(rng, depth + 1, ("b", "span", "br"))))
        elif tag in ("ul", "ol"):
            out.append((tag, attrs, [("li", rng.choice([{}, {}, {"class": "gone"}]), random_tree(rng, depth + 1, ("b", "ul", "ol", "div"))) for _ in range(rng.randrange(1, 4))]))
        elif tag == "table":
            out.append((tag, attrs, [("tr", {}, [("td", rng.choice([{}, {}, {}, {"rowspan": "2"}, {"colspan": "2"}]), [rng.choice(["a", "bb", "ccc dd", ""])])
                                                for _ in range(rng.randrange(1, 4))]) for _ in range(rng.randrange(1, 4))]))
        else:
            out.append((tag, attrs, random_tree(rng, depth + 1, allowed)))
    return out


def source(nodes):
    def one(n):
        if isinstance(n, str):
            return n
        tag, attrs, children = n
        head = "".join(f' {k}="{v}"' for k, v in attrs.items())
        return f"<{tag}{head}>" if tag == "br" else f"<{tag}{head}>{source(children)}</{tag}>"
    return "".join(map(one, nodes))


def events(nodes, seen, level, numbers):
    """Flat layout events of a tree: text, line breaks, block edges with their margin and indentation, markers, tables."""
    for n in nodes:
        if isinstance(n, str):
            yield from [("text", n)] if seen else []
            continue
        tag, attrs, children = n
        if "hidden" in attrs or attrs.get("class") == "gone":
            continue
        here = seen
        if attrs.get("id") == "dim" or "hidden" in attrs.get("style", ""):
            here = False
        if "visible" in attrs.get("style", ""):
            here = True
        if tag == "br":
            yield ("br",)
        elif tag == "table":
            yield ("open", True)
            yield ("table", [[("" if not here else " ".join(c[2][0].split()), int(c[1].get("colspan", 1)), int(c[1].get("rowspan", 1))) for c in row[2]] for row in children])
            yield ("close", True)
        elif tag in MARGINS + LINES:
            inner = tag in ("ul", "ol") and bool(numbers)
            deeper = level + (3 if tag in ("ul", "ol", "blockquote") else 0)
            yield ("open", tag in MARGINS and not inner)
            if tag == "li":
                numbers[-1][1] += 1
                yield ("marker", ("- " if numbers[-1][0] == "ul" else f"{numbers[-1][1]}. ") if here else "")
            yield ("indent", deeper)
            yield from events(children, here, deeper, numbers + [[tag, 0]] if tag in ("ul", "ol") else numbers)
            yield ("item",) if tag == "li" else ("edge",)
            yield ("indent", level)
            yield ("close", tag in MARGINS and not inner)
        else:
            yield from events(children, here, level, numbers)


def table_lines(rows):
    grid, width, busy = [], {}, set()
    for r, row in enumerate(rows):
        c, cells = 0, []
        for text, span, down in row:
            while (r, c) in busy:
                c += 1
            busy |= {(r + i, c + j) for i in range(down) for j in range(span)}
            cells.append((c, text))
            width[c] = max(width.get(c, 0), len(text) if span == 1 else 0)
            c += span
        grid.append(cells)
    out = []
    for cells in grid:
        lines = [""]
        for c, text in cells:
            start = sum(w + 2 for k, w in width.items() if k < c)
            if text:
                if len(lines[-1]) > max(0, start - 2):
                    lines.append("")
                lines[-1] = lines[-1].ljust(start) + text
        if any(text for _, text in cells):
            out += lines
    return out


def plain(nodes):
    lines, line, gap, indent, marker = [], "", False, 0, ""

    def end(force=False):
        nonlocal line, gap, marker
        body = line.rstrip(" ") if not line.startswith("\0") else line[1:]
        if body or force or marker:
            if lines and gap:
                lines.append("")
            lines.append((" " * max(0, indent - len(marker)) + marker + body).rstrip())
            gap, marker = False, ""
        line = ""
    for e in events(nodes, True, 0, []):
        if e[0] == "text":
            t = re.sub(r"\s+", " ", e[1])
            line = (line + t.lstrip(" ") if not line or line.endswith(" ") else line + t).lstrip(" ")
        elif e[0] == "br":
            end(True)
        elif e[0] in ("open", "close"):
            if line.strip(" "):
                end()
            line = ""
            gap = gap or e[1]
        elif e[0] == "edge":
            if line.strip(" "):
                end()
            line = ""
        elif e[0] == "item":
            end()
        elif e[0] == "indent":
            indent = e[1]
        elif e[0] == "marker":
            marker = e[1]
        else:
            for row in table_lines(e[1]):
                line = "\0" + row
                end(True)
            gap = True
    end()
    return "\n".join(lines)


def test_random_trees_against_a_plain_renderer():
    rng = random.Random(17)
    seen = 0
    for _ in range(4000):
        nodes = random_tree(rng)
        page = "<style>.gone{display:none} #dim{visibility:hidden}</style>" + source(nodes)
        assert render(page) == plain(nodes), page
        seen += "<table" in page and "<li" in page
    assert seen > 100
