"""HTML extraction by layout-aware rendering: all visible text, with block spacing, lists and aligned table cells.

A page's markup is read once, from left to right, and no part of it twice. The builder keeps the stack of open elements with the
places of each name on it, closes and opens those that HTML implies, and knows what is hidden; the renderer lays text out in flows (one
for the page, one for each open table cell). Nothing recurses, and time and memory are in proportion to the page, whatever stands in
it. Pages are independent: there is no shuffle.

Hidden are elements without a box (by their kind, the attribute hidden, display: none) and text whose visibility is hidden or
collapse, unless an element within makes it visible again. Both may come from an element's style or from the page's style sheets;
of these, rules of one compound selector (name, classes, id) count, in the order that the cascade gives them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(r"<(?=[a-zA-Z/!?])")
NAME = re.compile(r"</?+([a-zA-Z][^\s/>]*+)")
#: The rest of a tag. Only after an equals sign does a quote hide what would end the tag, and one that is never closed is a character.
REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
COMMENT_END = re.compile("--!?>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
#: Numeric references with many digits, which html.unescape would refuse.
LONG_REFERENCE = re.compile(r"&#(?:0*+([0-9]{8,})|[xX]0*+([0-9a-fA-F]{7,}));?")
ZEROS = re.compile(r"&#(?:([xX])0{8,}+(?=[0-9a-fA-F])|0{8,}+(?=[0-9]))")

# The element groups of the HTML standard that matter to the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript datalist iframe object video audio canvas noframes progress meter".split())
#: Formulas and drawings are seen, but for these parts of them; a slash ends an element within them.
FOREIGN, FOREIGN_HIDDEN = frozenset(("svg", "math")), frozenset("title desc defs metadata annotation annotation-xml".split())
UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"']*/\Z""")
RAW = frozenset("script style textarea title iframe noframes xmp".split())
IN_HEAD = frozenset("head title meta link base script style noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure hr fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body address article aside center details dialog dd dir div dt figcaption footer form header hgroup legend li listing main nav optgroup option search section summary".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p pre search section summary table ul".split()
)
#: start tag -> (open elements that it closes, elements beyond which it doesn't look).
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "td", "th", "table")),
    "dt": (("dt", "dd"), ("dl", "td", "th", "table")),
    "dd": (("dt", "dd"), ("dl", "td", "th", "table")),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("td", "th", "tr", "caption"), ("table",)),
    "thead": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("td", "th", "tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "caption": (("caption",), ("table",)),
}
CELL_SCOPE = frozenset(("td", "th", "caption"))
TABLE_PARTS = frozenset("table tr td th thead tbody tfoot caption".split())
#: Inputs whose value is drawn, and those that draw their placeholder where there is no value.
LABELLED = frozenset("submit button reset".split())
UNWRITTEN = frozenset("hidden password checkbox radio file image color range date datetime-local month week time".split())

GAP = "  "
#: Columns are as wide as their widest cell; where lines would take PADDING times the table's text, the widest are padded less, though
#: to PAD at least unless the table is huge.
PAD, PADDING = 60, 16
#: The standard's bounds of spans; columns that rowspans are followed in; levels of indents that are drawn, of tables that are laid out.
MOST_SPAN, MOST_ROWS, COLUMNS, INDENTS, NESTED = 1000, 65534, 200, 32, 16


def width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def unescaped(text: str) -> str:
    if "&" not in text:
        return text
    return html.unescape(LONG_REFERENCE.sub("\ufffd", ZEROS.sub(lambda m: f"&#{m[1] or ''}", text)) if "&#" in text else text)


# --- tokens ----------------------------------------------------------------------------------------------------------------


def tokens(page: str, foreign=lambda: False) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("start", name, attributes), ("end", name, "") and ("raw", name, text), names in small letters.

    A tag or comment that never ends takes what is left of the page with it, as in a browser. foreign: whether the place read at the
    moment lies in a formula or drawing, where CDATA is text.
    """
    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        begin = m.start() if m else size
        if begin > at:
            yield "text", "", page[at:begin]
        if not m:
            return
        name = NAME.match(page, begin)
        if not name:
            at = _beyond(page, begin, foreign())
            if page.startswith("<![CDATA[", begin) and foreign():
                yield "text", "", page[begin + 9 : at - 3 if page.startswith("]]>", at - 3) else at]
            continue
        rest = REST.match(page, name.end())
        if not rest:
            return
        at, tag = rest.end(), name[1].lower()
        if page[begin + 1] == "/":
            yield "end", tag, ""
            continue
        yield "start", tag, rest[1]
        if tag == "plaintext":
            yield "text", "", page[at:]
            return
        if tag in RAW and not foreign():
            close = re.compile(rf"(?i)</{tag}(?=[\s/>])[^>]*+>?").search(page, at)
            stop = close.start() if close else size
            yield "raw", tag, page[at:stop]
            yield "end", tag, ""
            at = close.end() if close else size
        elif tag in ("pre", "listing") and page.startswith("\n", at):
            at += 1


def _beyond(page: str, begin: int, foreign: bool) -> int:
    """Where a comment, declaration or other markup that is no tag ends."""
    if page.startswith("<!--", begin):
        if page.startswith((">", "->"), begin + 4):
            return page.index(">", begin) + 1
        end = COMMENT_END.search(page, begin + 4)
        return end.end() if end else len(page)
    if foreign and page.startswith("<![CDATA[", begin):
        end = page.find("]]>", begin)
        return end + 3 if end >= 0 else len(page)
    end = page.find(">", begin)
    return end + 1 if end >= 0 else len(page)


def slashed(attributes: str) -> bool:
    return attributes.endswith("/") and not UNQUOTED_SLASH.search(attributes)


def attributes_of(text: str) -> dict[str, str]:
    """The first of each name counts."""
    known: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        known.setdefault(m[1].lower(), unescaped(m[2] or m[3] or m[4] or ""))
    return known


# --- style -----------------------------------------------------------------------------------------------------------------

DECLARATION = re.compile(r"(?:\A|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
SELECTOR = re.compile(r"\A([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)\Z", re.I)
STYLES = re.compile(r"<style.*?(?:</style|\Z)", re.S | re.I)
HIDES = re.compile("none|hidden|collapse", re.I)
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)


def declared(style: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of display and visibility."""
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in DECLARATION.finditer(style)]


class Sheet:
    """The rules of a page's style sheets that set display or visibility.

    Rules of one selector are kept as one, with what wins among them. A selector is looked up by the one of its parts (classes, id) that
    the fewest selectors have, and what an element's name, classes and id lead to is worked out once, however many elements have them.
    So n rules over n elements take time in proportion to n, unless the selectors are pairs of a few classes in all combinations.
    """

    def __init__(self, sheets: list[str]):
        #: name, parts -> property -> (important, 0, weight), value
        self.rules: dict[tuple[str, frozenset], dict[str, tuple]] = {}
        self.known: dict[tuple, list] = {}
        n = 0
        for text in sheets:
            text = CSS_COMMENT.sub(" ", text)
            opened: list[bool] = []  # of each open block, whether its rules count
            at = 0
            for m in re.finditer(r"[{};]", text):
                before = text[at : m.start()].strip()
                if m[0] == ";":
                    if not opened:
                        at = m.end()
                    continue
                at = m.end()
                if m[0] == "{":
                    opened.append((not opened or opened[-1]) and (not before.startswith("@") or bool(re.fullmatch(r"(?i)@media\s+(?:only\s+)?(?:screen|all)", before))))
                    selectors = before
                elif opened:
                    counts = opened.pop()
                    if counts and not selectors.startswith("@"):
                        n += self._add(selectors, declared(before), n)
                    selectors = "@"

    def _add(self, selectors: str, found: list, n: int) -> int:
        for one in selectors.split(",") if found else ():
            m = SELECTOR.match(one.strip())
            if not m or not one.strip():
                continue
            parts = re.findall(r"[.#][\w-]+", m[2])
            name = (m[1] or "*").lower()
            weight = (sum(p[0] == "#" for p in parts), sum(p[0] == "." for p in parts), int(name != "*"), n)
            winning = self.rules.setdefault((name, frozenset(parts)), {})
            for prop, value, important in found:
                won = (important, 0, *weight), value
                if prop not in winning or winning[prop][0] <= won[0]:
                    winning[prop] = won
        return 1

    def index(self) -> None:
        """Put each selector under its rarest part, or its name where it has none."""
        shared = Counter(p for _, parts in self.rules for p in parts)
        self.under: dict[str, list[tuple]] = {}
        for (name, parts), winning in self.rules.items():
            key = min(parts, key=lambda p: (shared[p], p)) if parts else name
            self.under.setdefault(key, []).append((name, parts, winning))

    def of(self, tag: str, known: dict[str, str]) -> list[tuple[tuple, str, str]]:
        """(weight, property, value) of what wins for an element, by property."""
        signature = tag, known.get("class", ""), known.get("id", "")
        out = self.known.get(signature)
        if out is None:
            own = {f".{c}" for c in signature[1].split()} | ({f"#{signature[2].strip()}"} if signature[2] else set())
            best: dict[str, tuple] = {}
            for key in (*own, tag, "*"):
                for name, parts, winning in self.under.get(key, ()):
                    if name in ("*", tag) and parts <= own:
                        for prop, won in winning.items():
                            if prop not in best or best[prop] < won:
                                best[prop] = won
            out = self.known[signature] = [(weight, prop, value) for prop, (weight, value) in best.items()]
        return out


def sheet_of(page: str) -> Sheet | None:
    """The page's style sheets; none if they hide nothing."""
    # Every sheet lies in one of these stretches; most pages' sheets hide nothing, and only the others are looked at closely.
    if not any(HIDES.search(m[0]) for m in STYLES.finditer(page)):
        return None
    found, drawn = [], []
    for kind, name, text in tokens(page, lambda: bool(drawn)):
        if kind == "raw" and name == "style":
            found.append(text)
        elif kind == "start" and name in FOREIGN and not slashed(text):
            drawn.append(name)
        elif kind == "end" and name in FOREIGN and drawn:
            drawn.pop()
    sheet = Sheet(found)
    sheet.index()
    return sheet if sheet.rules else None


# --- layout ----------------------------------------------------------------------------------------------------------------


class Flow:
    """Lines of a page or cell. Margins between blocks don't add up: the larger counts."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False  # a space is due before the next word
        self.margin = 0
        self.indent: list[str] = []
        self.marker = ""

    def text(self, words: list[str], before: bool, after: bool) -> None:
        if words:
            if self.parts and (self.space or before):
                self.parts.append(" ")
            self.parts.append(" ".join(words))
            self.space = after
        elif before:
            self.space = True

    def exact(self, text: str) -> None:
        """Preformatted text."""
        first, *rest = text.split("\n")
        self.parts.append(first)
        for line in rest:
            self.break_line(True)
            self.parts.append(line)

    def break_line(self, forced: bool = False) -> None:
        line = "".join(self.parts)
        self.parts, self.space = [], False
        if not line and not forced:
            return
        if self.lines:
            self.lines += [""] * self.margin
        self.margin = 0
        lead = "".join(self.indent[: min(INDENTS, len(self.indent) - bool(self.marker))]) + self.marker
        self.marker = ""
        self.lines.append((lead + line).rstrip())

    def block(self, margin: int) -> None:
        self.break_line()
        self.margin = max(self.margin, margin)

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            self.parts = [line]
            self.break_line(True)

    def done(self) -> list[str]:
        self.break_line()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []

    def lines(self) -> list[str]:
        """Cells side by side, each column as wide as its widest cell of one column."""
        grid: list[list[tuple[int, list[str]]]] = []
        taken: dict[int, int] = {}  # column -> rows that a cell from above still covers
        size: dict[int, int] = {}
        text = 0
        for row in self.rows:
            cells, at = [], 0
            covered = taken
            taken = {c: n - 1 for c, n in covered.items() if n > 1}
            for lines, cols, deep in row:
                while at in covered:
                    at += 1
                cells.append((at, lines))
                widest = max(map(width, lines), default=0)
                text += sum(map(len, lines))
                if cols == 1:
                    size[at] = max(size.get(at, 0), widest)
                if deep > 1:
                    taken.update((c, deep - 1) for c in range(at, min(at + cols, COLUMNS)))
                at += cols
            grid.append(cells)
        most = self._most(size, sum(max((len(x) for _, x in cells), default=0) for cells in grid), text)
        left, upto = {}, 0
        for c in sorted(size):
            left[c] = upto
            upto += min(size[c], most) + len(GAP)
        known = sorted(left)
        out = list(self.caption)
        for cells in grid:
            # A column without a cell of its own stands where the next one that has some does, or behind them all.
            begins = []
            for c, _ in cells:
                i = bisect_right(known, c - 1)
                begins.append(left[known[i]] if i < len(known) else upto)
            active = list(range(len(cells)))
            for k in range(max((len(x) for _, x in cells), default=0)):
                active = [i for i in active if k < len(cells[i][1])]
                parts, at = [], 0
                for i in active:
                    piece = cells[i][1][k]
                    if piece:
                        gap = max(begins[i] - at, len(GAP) if at else 0)
                        parts += [" " * gap, piece]
                        at += gap + width(piece)
                out.append("".join(parts).rstrip())
        return out

    @staticmethod
    def _most(size: dict[int, int], n_lines: int, text: int) -> int:
        """The width to which columns are padded at most, so that n_lines lines hold about PADDING times the text."""
        least = PAD if PAD * len(size) * n_lines <= 1_000_000 else 1
        room = max(1, PADDING * text // max(1, n_lines))
        widths = sorted(size.values())
        for i, w in enumerate(widths):
            if w * (len(widths) - i) > room:
                return max(least, room // (len(widths) - i))
            room -= w
        return max(least, widths[-1] if widths else 0)


class Renderer:
    def __init__(self, sheet: Sheet | None = None):
        self.sheet = sheet
        self.open: list[tuple[str, bool, bool]] = []  # name, whether it hides what is in it, whether its text is visible
        self.where: dict[str, list[int]] = {}  # name -> places on the stack
        self.hidden = 0
        self.pre = 0
        self.flows = [Flow()]
        self.tables: list[Table | None] = []  # None for tables too deep to be laid out
        self.lists: list[list] = []  # [ordered, next number, type, step]

    # --- the tree ---

    def last(self, names) -> int:
        """The highest place of any of the names; -1 if none is open."""
        return max((self.where[x][-1] for x in names if self.where.get(x)), default=-1)

    def start(self, tag: str, attributes: str) -> None:
        if self.where.get("head") and tag not in IN_HEAD:
            self.end("head")
        if tag in CLOSES_P and self.where.get("p"):
            self.close_to("p", CELL_SCOPE | {"button", "table"})
        rule = IMPLIED.get(tag)
        if rule:
            closes, beyond = rule
            limit = self.last(beyond)
            # The outermost element within the limit that it closes.
            found = []
            for x in closes:
                places = self.where.get(x) or []
                i = bisect_right(places, limit)
                found += places[i : i + 1]
            if found:
                self.pop_to(min(found))
            if tag in ("td", "th") and self.last(("tr",)) <= self.last(("table",)):
                self.push("tr", "")
        self.push(tag, attributes)

    def foreign(self, tag: str = "") -> bool:
        """Whether a start tag opens, or lies directly in, a formula or drawing."""
        if tag in FOREIGN:
            return True
        if tag in BLOCKS:
            return False
        return self.last(FOREIGN) > self.last(("foreignobject",))

    def push(self, tag: str, attributes: str) -> None:
        foreign = self.foreign(tag)
        if foreign and slashed(attributes):
            return
        gone = tag in HIDDEN or foreign and tag in FOREIGN_HIDDEN
        seen = self.open[-1][2] if self.open else True
        known: dict[str, str] = {}
        if self.sheet or attributes and not attributes.isspace():
            lower = attributes.lower()
            if self.sheet or tag in ("input", "ol", "li", "td", "th", "dialog") or "hidden" in lower or "style" in lower:
                known = attributes_of(attributes)
                rules = list(self.sheet.of(tag, known)) if self.sheet else []
                rules += [((important, 1, i), prop, value) for i, (prop, value, important) in enumerate(declared(known.get("style", "")))]
                final = {prop: value for _, prop, value in sorted(rules)}
                if "display" in final:
                    gone = gone or final["display"] == "none"
                elif "hidden" in known:
                    gone = True
                if final.get("visibility") in ("hidden", "collapse", "visible"):
                    seen = final["visibility"] == "visible"
        if tag == "dialog" and "open" not in known:
            gone = True
        if tag in VOID:
            if not self.hidden and not gone:
                if tag == "br":
                    self.flows[-1].break_line(True)
                elif tag == "hr":
                    self.flows[-1].block(1)
                elif tag == "input" and seen:
                    self.input(known)
            return
        self.open.append((tag, gone, seen))
        self.where.setdefault(tag, []).append(len(self.open) - 1)
        self.hidden += gone
        if not self.hidden:
            self.enter(tag, known)

    def input(self, known: dict[str, str]) -> None:
        kind = known.get("type", "text").lower()
        shown = "" if kind in UNWRITTEN else known.get("value") or ("" if kind in LABELLED else known.get("placeholder", ""))
        if shown.split():
            self.flows[-1].text(shown.split(), True, True)

    def pop_to(self, i: int) -> None:
        while len(self.open) > i:
            tag, gone, _ = self.open.pop()
            self.where[tag].pop()
            if not self.hidden:
                self.leave(tag)
            self.hidden -= gone

    def close_to(self, tag: str, beyond) -> None:
        at = self.last((tag,))
        if at > self.last(x for x in beyond if x != tag):
            self.pop_to(at)

    def end(self, tag: str) -> None:
        if not self.where.get(tag):
            if tag == "br":
                self.push("br", "")
            elif tag == "p":
                self.start("p", "")
                self.end("p")
            return
        self.close_to(tag, frozenset(("table",)) if tag in TABLE_PARTS and tag != "table" else () if tag in TABLE_PARTS else CELL_SCOPE | {"table"})

    # --- the layout ---

    def enter(self, tag: str, known: dict[str, str]) -> None:
        flow = self.flows[-1]
        if tag == "text" and self.where.get("svg"):
            flow.space = True  # each has a place of its own in the drawing
        if tag in ("td", "th", "caption"):
            if self.tables and self.tables[-1] is None:
                flow.block(0)
                return
            if tag != "caption" and self.tables and not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            self.flows.append(Flow())
            self.flows[-1].spans = (number(known.get("colspan"), MOST_SPAN), number(known.get("rowspan"), MOST_ROWS))
        elif tag == "tr":
            if self.tables and self.tables[-1]:
                self.tables[-1].rows.append([])
        elif tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu") and self.lists
            flow.block(1 if tag in SPACED and not nested else 0)
            if tag == "table":
                self.tables.append(Table() if len(self.tables) < NESTED else None)
            elif tag in ("ul", "ol", "menu"):
                first = number(known.get("start"), 10**9) if tag == "ol" else 0
                self.lists.append([tag == "ol", first, known.get("type", "1"), -1 if "reversed" in known and "start" in known else 1])
                flow.indent.append("")
            elif tag == "li":
                kind = self.lists[-1] if self.lists else [False, 0, "1", 1]
                if kind[0] and "value" in known:
                    kind[1] = number(known["value"], 10**9)
                flow.marker = f"{numeral(kind[1], kind[2])}. " if kind[0] else "- "
                kind[1] += kind[3]
                flow.indent.append(" " * len(flow.marker))
            elif tag in ("dd", "blockquote"):
                flow.indent.append("    " if tag == "dd" else "> ")
            elif tag in ("pre", "listing"):
                self.pre += 1

    def leave(self, tag: str) -> None:
        if tag in ("td", "th", "caption"):
            if self.tables and self.tables[-1] is None:
                self.flows[-1].block(0)
                return
            if len(self.flows) == 1:
                return
            cell = self.flows.pop()
            lines = cell.done()
            if not self.tables:
                self.flows[-1].block(0)
                self.flows[-1].rows(lines)
            elif tag == "caption":
                self.tables[-1].caption += lines
            else:
                self.tables[-1].rows[-1].append((lines, *cell.spans))
            return
        if tag not in BLOCKS:
            if tag == "text":
                self.flows[-1].space = True
            return
        flow = self.flows[-1]
        nested = tag in ("ul", "ol", "menu") and len(self.lists) > 1
        flow.block(1 if tag in SPACED and not nested else 0)
        if tag == "table":
            table = self.tables.pop()
            if table:
                flow.rows(table.lines())
            flow.block(1)
        elif tag in ("ul", "ol", "menu"):
            self.lists.pop()
            flow.indent.pop()
        elif tag == "li":
            if flow.marker:
                flow.break_line(True)  # an item without text is still seen
            flow.indent.pop()
        elif tag in ("dd", "blockquote"):
            flow.indent.pop()
        elif tag in ("pre", "listing"):
            self.pre -= 1

    def text(self, text: str) -> None:
        if self.where.get("head") and not text.isspace() and self.open[-1][0] == "head":
            self.end("head")
        if self.hidden:
            return
        if self.open and not self.open[-1][2]:
            self.flows[-1].space = True  # invisible text takes room
            return
        text = unescaped(text)
        if self.pre:
            self.flows[-1].exact(text)
            return
        # Only ASCII blanks collapse; a no-break space is a character of its own, shown as a space.
        words = text.split() if text.isascii() else [w for w in re.split(r"[ \t\n\f\r]+", text) if w]
        if words or text:
            self.flows[-1].text([w.replace("\xa0", " ") for w in words], text[:1] in " \t\n\f\r", text[-1:] in " \t\n\f\r")

    def render(self, page: str) -> str:
        for kind, name, text in tokens(page, self.foreign):
            if kind == "start":
                self.start(name, text)
            elif kind == "end":
                self.end(name)
            elif kind == "text":
                self.text(text)
            elif name in ("textarea", "xmp"):
                self.text(f" {text} ")
        self.pop_to(0)
        return "\n".join(self.flows[0].done()).strip("\n")


# What Roman numerals are made of.
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def numeral(n: int, kind: str) -> str:
    """A list item's number as its list's type (1, a, A, i, I) writes it; numbers beyond a type's range are written in digits."""
    out, low = "", kind.lower()
    if low == "a" and n > 0:
        while n > 0:
            n, digit = divmod(n - 1, 26)
            out = chr(97 + digit) + out
    elif low == "i" and 0 < n < 4000:
        for value, letters in ROMAN:
            times, n = divmod(n, value)
            out += letters * times
    else:
        return str(n)
    return out.upper() if kind != low else out


def number(text: str | None, most: int) -> int:
    m = re.match(r"\s*([0-9]{1,9})", text or "")
    return min(most, max(1, int(m[1]))) if m else 1


def visible_text(page: str | None) -> str:
    """What a reader sees of a page, line by line. Null and empty pages, and those with nothing to see, give the empty text."""
    return Renderer(sheet_of(page)).render(page) if page else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of pages: page_id, text, n_chars. Repeated rows are rendered alike; other columns aren't read."""

    def run(batches):
        for batch in batches:
            texts = [visible_text(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(run, "page_id bigint, text string, n_chars bigint")
