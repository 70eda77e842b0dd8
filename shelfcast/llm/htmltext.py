"""HTML extraction by layout: a tree with implied tags, visibility rules, and a text rendering.

Tags are read into a tree as a browser would close them: a paragraph ends at the next block, list
items, cells, rows and options end at their next sibling, rows get their table sections.  The tree
is then rendered: what is not displayed is left out, all other text is emitted with white space
collapsed as displayed, blocks on lines of their own, blank lines around paragraphs, markers and
indentation for lists, and table cells aligned in columns.  Formulas (MathML) and the texts of
drawings (SVG) are text within their line; buttons and text fields show their value.

Visibility follows attributes (``hidden``, ``open`` of details and dialogs), inline styles and the page's ``<style>``
rules for tags, classes, ids and their compounds (``display`` and ``visibility``, by importance, specificity and order;
rules of other selectors and within @-blocks are not applied).  An invisible element keeps its place,
and a visible one inside it shows.  Columns are as wide as their cells; a cell of more than COLUMN characters that others
follow is wrapped at blanks, and a longer word lets what follows begin on the next line, in its column.
Cells span columns and rows.

A null page has a null text, an empty one an empty text.  Unclosed comments, tags and raw-text
elements reach to the end of the page.  Repeated rows are rendered alike."""

from __future__ import annotations

import html
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# The element classes of HTML that matter for layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes textarea title xmp noscript template".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes datalist audio video canvas object title".split())
#: Types of input that show their value; one without a type is a text field.
SHOWS_VALUE = frozenset("submit reset button text search url tel email number".split()) | {""}
#: Elements of drawings and formulas that are not shown where they stand.
UNDRAWN = {"svg": frozenset("title desc defs metadata symbol clippath mask pattern marker".split()), "math": frozenset(("annotation", "annotation-xml"))}
HEAD = frozenset("head base link meta title script style noscript template".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset form article section header footer nav aside main".split())
BLOCK = MARGIN | frozenset("html body div li dt dd address center details summary figcaption legend caption tr option optgroup select menu".split())
ENDS_P = BLOCK - {"option", "optgroup", "select", "html", "body", "caption", "tr"}
#: What a start tag closes, and the ancestors beyond which it does not look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "caption"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
P_SCOPE = frozenset(("td", "th", "caption", "table", "button", "object", "html"))
SECTIONS = frozenset(("tbody", "thead", "tfoot"))

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WHITE = re.compile(r"[ \t\n\f\r]+")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
QUOTE_OR_END = re.compile("[\"'>]")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: A simple selector: a tag, and classes and ids, without anything between.
SIMPLE = re.compile(r"([a-zA-Z][a-zA-Z0-9]*|\*)?((?:[.#][\w-]+)*)\Z")
#: Characters up to which a column is as wide as its cells.
COLUMN = 200


class Node:
    __slots__ = ("tag", "gone", "named", "children")

    def __init__(self, tag: str, named: dict[str, str] | None = None, gone: bool = False):
        self.tag, self.named, self.gone, self.children = tag, named or {}, gone, []


class Quotes:
    """Finds where tags end; a quote that no other follows on the page does not open a string."""

    def __init__(self, page: str):
        self.page, self.last = page, {c: page.rfind(c) for c in "\"'"}

    def tag_end(self, at: int) -> int:
        """Position after the > that ends the tag at ``at``; a > within quotes does not."""
        page, plain = self.page, page_end(self.page, at)
        while m := QUOTE_OR_END.search(page, at):
            c, i = m.group(), m.start()
            if c == ">":
                return i + 1
            at = i + 1
            if page[i - 1] in "= \t\n\f\r":
                if self.last[c] <= i:
                    return plain
                at = page.find(c, i + 1) + 1
        return plain


def page_end(page: str, at: int) -> int:
    end = page.find(">", at)
    return len(page) if end < 0 else end + 1


# -- styles

def declarations(source: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of display and visibility, in order."""
    out = []
    for part in source.split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if name in ("display", "visibility") and value:
            important = value.endswith("!important")
            out.append((name, value.removesuffix("!important").strip(), important))
    return out


class Styles:
    """The rules of a page's style sheets that decide what shows."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list] = {}
        order = 0
        for sheet in sheets:
            for selectors, body in blocks(COMMENT.sub(" ", sheet)):
                found = declarations(body)
                for selector in selectors.split(",") if found else ():
                    m = SIMPLE.match(selector.strip())
                    if not m or not m.group():
                        continue
                    names = re.findall(r"[.#][\w-]+", m.group(2))
                    tag = (m.group(1) or "*").lower()
                    ids, classes = [n[1:] for n in names if n[0] == "#"], [n[1:] for n in names if n[0] == "."]
                    weight = (len(ids), len(classes), tag != "*")
                    key = "#" + ids[0] if ids else "." + classes[0] if classes else tag
                    order += 1
                    self.rules.setdefault(key, []).append((weight, order, tag, frozenset(ids), frozenset(classes), found))

    def of(self, node: Node) -> dict[str, str]:
        """The winning values of display and visibility, from rules and the inline style."""
        inline = node.named.get("style")
        if not self.rules and not inline:
            return {}
        classes, own = frozenset(node.named.get("class", "").split()), node.named.get("id")
        best: dict[str, tuple] = {}
        for key in (node.tag, "*", *("." + c for c in classes), *(("#" + own,) if own else ())):
            for weight, order, tag, ids, some, found in self.rules.get(key, ()):
                if tag in ("*", node.tag) and some <= classes and ids <= {own}:
                    for i, (name, value, important) in enumerate(found):
                        best[name] = max(best.get(name, ((),)), ((important, 0, weight, order, i), value))
        for i, (name, value, important) in enumerate(declarations(inline or "")):
            best[name] = max(best.get(name, ((),)), ((important, 1, (), 0, i), value))
        return {name: value for name, (_, value) in best.items()}


def blocks(sheet: str):
    """(selectors, declarations) of the rules outside @-blocks."""
    at = 0
    while (open_ := sheet.find("{", at)) >= 0:
        head = sheet[at:open_]
        head = head[head.rfind(";") + 1:].strip()
        close = sheet.find("}", open_)
        if head.startswith("@"):
            depth, i = 1, open_ + 1
            while depth and (m := re.compile("[{}]").search(sheet, i)):
                depth, i = depth + (1 if m.group() == "{" else -1), m.end()
            at = i if not depth else len(sheet)
            continue
        close = len(sheet) if close < 0 else close
        yield head, sheet[open_ + 1:close]
        at = close + 1


def attributes(source: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(source)}


def number(value: str | None, default: int, most: int) -> int:
    return min(most, int(value)) if value and value.isascii() and value.isdigit() and len(value) < 10 else default


class Builder:
    """Puts tags and text where a browser would."""

    def __init__(self):
        self.root, self.sheets = Node("html"), []
        self.stack, self.count = [self.root], {"html": 1}

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def pop(self) -> None:
        self.count[self.stack.pop().tag] -= 1

    def close(self, tags, scope) -> None:
        """Pop up to and including the nearest of ``tags``, unless one of ``scope`` is nearer."""
        if not any(self.count.get(t) for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in scope:
                return

    def text(self, data: str) -> None:
        if self.count.get("head") and not data.isspace():
            self.close({"head"}, ())
        self.stack[-1].children.append(data)

    def start(self, tag: str, source: str) -> None:
        if self.count.get("head") and tag not in HEAD:
            self.close({"head"}, ())
        if tag in ("html", "body"):
            return
        if tag in ENDS_P and self.count.get("p"):
            self.close({"p"}, P_SCOPE)
        if tag in CLOSES:
            self.close(*CLOSES[tag])
        if tag in ("td", "th", "tr") and self.count.get("table"):
            if self.stack[-1].tag == "table":
                self.push(Node("tbody"))
            if tag != "tr" and self.stack[-1].tag in SECTIONS:
                self.push(Node("tr"))
        named = attributes(source) if source and not source.isspace() else {}
        gone = tag in HIDDEN or any(tag in UNDRAWN[k] and self.count.get(k) for k in UNDRAWN)
        node = Node(tag, named, gone or tag == "input" and named.get("type", "").lower() == "hidden")
        if tag in VOID or self.foreign() and source.endswith("/"):
            self.stack[-1].children.append(node)
        else:
            self.push(node)

    def foreign(self) -> bool:
        """Within a drawing or formula, where a tag may close itself."""
        return bool(self.count.get("svg") or self.count.get("math"))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.stack[-1].children.append(Node("br"))
        elif tag == "p" and not self.count.get("p"):
            self.stack[-1].children.append(Node("p"))
        elif tag not in ("html", "body"):
            self.close({tag}, {"table"} if tag not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption") and self.count.get(tag) and self.stack[-1].tag in SECTIONS | {"tr", "table"} else ())


def parse(page: str) -> tuple[Node, Styles]:
    """The tree of a page and its style rules."""
    tree, at, n, quotes = Builder(), 0, len(page), Quotes(page)
    low = None
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            tree.text(html.unescape(page[at:]))
            break
        if begin > at:
            tree.text(html.unescape(page[at:begin]))
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[begin + 1:begin + 2]
        if after in ("!", "?"):
            end = page.find(">", begin)
            at = n if end < 0 else end + 1
            continue
        name = TAG_NAME.match(page, begin + 1 + (after == "/"))
        if not name:
            tree.text("<")
            at = begin + 1
            continue
        end, tag = quotes.tag_end(name.end()), name.group().lower()
        if after == "/":
            tree.end(tag)
            at = end
            continue
        tree.start(tag, page[name.end():end].rstrip(">"))
        at = end + (tag == "pre" and page.startswith("\n", end))
        if tag in RAW and not (tree.foreign() and page.startswith("/>", end - 2)):
            low = page.lower() if low is None and len(page.lower()) == n else low
            close = (low or page).find(f"</{tag}", at)
            stop = n if close < 0 else close
            if tag not in HIDDEN:
                tree.text(html.unescape(page[at:stop]))
            elif tag == "style":
                tree.sheets.append(page[at:stop])
            tree.end(tag)
            at = n if close < 0 else quotes.tag_end(close + 2)
    return tree.root, Styles(tree.sheets)


class Flow:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space, self.gap, self.indent, self.marker = False, 0, 0, ""

    def text(self, data: str) -> None:
        words = WHITE.split(data)
        if len(words) == 1 and not words[0]:
            return
        self.space = self.space or (not words[0] and len(words) > 1)
        inner = " ".join(w for w in words if w)
        if inner:
            if self.parts and self.space:
                self.parts.append(" ")
            self.parts.append(inner)
            self.space = False
        if not words[-1]:
            self.space = True

    def verbatim(self, data: str) -> None:
        for i, line in enumerate(data.split("\n")):
            if i:
                self.end_line(True)
            self.parts.append(line.replace("\r", ""))

    def end_line(self, even_empty: bool = False) -> None:
        if self.parts or even_empty or self.marker:
            if self.lines and self.gap:
                self.lines.append("")
            self.lines.append((" " * max(0, self.indent - len(self.marker)) + self.marker + "".join(self.parts)).rstrip())
            self.gap, self.marker, self.parts = 0, "", []
        self.space = False

    def block(self, margin: bool = False) -> None:
        self.end_line() if self.parts else None
        self.gap = self.gap or int(margin)

    def finished(self) -> list[str]:
        self.end_line()
        return self.lines


def wrapped(line: str) -> list[str]:
    """A line as lines of at most COLUMN characters, cut at blanks; longer words stay whole."""
    out: list[str] = []
    for word in line.split(" "):
        if out and len(out[-1]) + 1 + len(word) <= COLUMN:
            out[-1] += " " + word
        else:
            out.append(word)
    return out


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """The lines of a table whose rows are lists of (lines of the cell, columns, rows it spans)."""
    placed, taken = [], {}
    for row in rows:
        column, cells = 0, []
        for lines, span, down in row:
            while taken.get(column):
                column += 1
            cells.append([column, span, lines])
            for c in range(column, column + span):
                taken[c] = max(taken.get(c, 0), down)
            column += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in cells[:-1]:
            cell[2] = [part for line in cell[2] for part in (wrapped(line) if len(line) > COLUMN else [line])]
        placed.append(cells)
    width: dict[int, int] = {}
    for cells in placed:
        for column, span, lines in cells:
            if span == 1:
                longest = max((len(line) for line in lines if len(line) <= COLUMN), default=0)
                width[column] = max(width.get(column, 0), longest)
            else:
                width.setdefault(column, 0)
    columns = sorted(width)
    begin = dict(zip(columns, [0, *itertools.accumulate(width[c] + 2 for c in columns)]))
    out = []
    for cells in placed:
        for i in range(max((len(lines) for *_, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                part = lines[i] if i < len(lines) else ""
                if not part:
                    continue
                if len(line) > max(0, begin[column] - 2):
                    out.append(line)
                    line = ""
                line = line.ljust(begin[column]) + part
            out.append(line.rstrip())
    return out


def displayed(node: Node, style: dict[str, str]) -> bool:
    """Whether an element takes part in the layout."""
    if node.gone:
        return False
    if "display" in style:
        return style["display"] != "none"
    return not ("hidden" in node.named or node.tag == "dialog" and "open" not in node.named)


def shown_children(node: Node) -> list:
    """The children of an element; of a closed details its first summary only."""
    if node.tag != "details" or "open" in node.named:
        return node.children
    return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]


def render(page: str | None) -> str | None:
    """The visible text of a page as laid out."""
    if page is None:
        return None
    tree, styles = parse(page)
    flows, tables, lists, pre, drawn = [Flow()], [], [], 0, 0
    # what is on the way down: whether its text shows
    visible = [True]
    work: list[tuple[object, bool]] = [(tree, True)]
    while work:
        node, enter = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if visible[-1]:
                flow.verbatim(node) if pre else flow.text(node)
            continue
        tag = node.tag
        if enter:
            style = styles.of(node)
            if not displayed(node, style):
                continue
            if tag == "br":
                flow.end_line(not flow.parts)
                continue
            seen = visible[-1] if style.get("visibility", "inherit") == "inherit" else style["visibility"] not in ("hidden", "collapse")
            if tag == "input":
                if seen and node.named.get("type", "").lower() in SHOWS_VALUE:
                    flow.text(node.named.get("value", ""))
                continue
            visible.append(seen)
            if tag in BLOCK or tag in ("td", "th"):
                flow.block(tag in MARGIN and not (tag in ("ul", "ol") and lists))
            if tag == "pre":
                pre += 1
            elif tag == "svg":
                drawn += 1
            elif tag == "text" and drawn:
                flow.space = True
            elif tag in ("ul", "ol", "menu"):
                lists.append([tag, number(node.named.get("start"), 1, 10**9)])
                flow.indent += 3
            elif tag in ("blockquote", "dd"):
                flow.indent += 3
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                flow.marker = marker if seen else ""
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables and tables[-1]:
                flows.append(Flow())
            work.append((node, False))
            work += [(child, True) for child in reversed(shown_children(node))]
            continue
        visible.pop()
        if tag in ("td", "th") and tables and tables[-1]:
            down = number(node.named.get("rowspan"), 1, 65534)
            tables[-1][-1].append((flows.pop().finished(), max(1, number(node.named.get("colspan"), 1, 1000)), down if down else 1 << 30))
            continue
        if tag in BLOCK:
            flow.end_line() if tag == "li" else flow.block()
            flow.gap = flow.gap or int(tag in MARGIN and not (tag in ("ul", "ol") and len(lists) > 1))
        if tag == "pre":
            pre -= 1
        elif tag == "svg":
            drawn -= 1
        elif tag == "text" and drawn:
            flow.space = True
        elif tag in ("ul", "ol", "menu"):
            lists.pop()
            flow.indent -= 3
        elif tag in ("blockquote", "dd"):
            flow.indent -= 3
        elif tag == "table":
            for line in aligned(tables.pop()):
                flow.parts = [line] if line else []
                flow.end_line(True)
            flow.gap = 1
    return "\n".join(flows[0].finished())


def rendered(pages: DataFrame) -> DataFrame:
    """page_id, text and n_chars of every page."""
    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [render(p.as_py()) for p in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])
    out = map_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), "html"), one, "page_id long, text string")
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
