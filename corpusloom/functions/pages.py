"""Web pages as trees: texts with mathematics, rows of listings and catalogues.

The tree keeps text and elements in document order and takes unclosed and stray tags as they
come. What is done to it is counted, and the counters travel beside the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

# Elements without an end, and what ends a paragraph.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MODULE_BLOCKS = {"p", "div", "section", "h1", "h2", "h3", "h4", "h5", "li", "table", "tr", "blockquote"}
TEXTBOOK_BLOCKS = {"p", "div", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "tr", "blockquote", "dl", "dt", "dd"}
# What is masked in pages, and by which names.
MASKED = (
    ("email", re.compile(r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b")),
    ("labelled_phone", re.compile(r"(?i)(?:\btelefon|\btel\.)\s*:?\s*(?:\+48\s*)?\d(?:[ .-]?\d){8}\b")),
)
# Operators without a visible sign, as they are written in formulas.
UNSEEN = {"⁢": " \\cdot ", "⁡": " ", "⁣": ", "}
UNCONVERTED = "[UNCONVERTED_MATHML]"
#: Signs that have a name in LaTeX; others stand for themselves.
SIGNS = {
    "≤": "\\leq", "≥": "\\geq", "≠": "\\neq", "≈": "\\approx", "±": "\\pm", "×": "\\times", "⋅": "\\cdot", "·": "\\cdot", "÷": "\\div", "→": "\\rightarrow", "⇒": "\\Rightarrow", "↔": "\\leftrightarrow",
    "∞": "\\infty", "∑": "\\sum", "∏": "\\prod", "∫": "\\int", "∂": "\\partial", "∇": "\\nabla", "∈": "\\in", "∉": "\\notin", "⊂": "\\subset", "∪": "\\cup", "∩": "\\cap", "√": "\\sqrt{}", "−": "-",
    "α": "\\alpha", "β": "\\beta", "γ": "\\gamma", "δ": "\\delta", "ε": "\\epsilon", "θ": "\\theta", "λ": "\\lambda", "μ": "\\mu", "ν": "\\nu", "π": "\\pi", "ρ": "\\rho", "σ": "\\sigma", "τ": "\\tau",
    "φ": "\\phi", "ω": "\\omega", "Δ": "\\Delta", "Σ": "\\Sigma", "Ω": "\\Omega", "Φ": "\\Phi", "Γ": "\\Gamma", "Λ": "\\Lambda", "%": "\\%", "#": "\\#", "&": "\\&", "{": "\\{", "}": "\\}",
}


@dataclass(eq=False)
class Element:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    inside: list[Element | str] = field(default_factory=list)

    def elements(self) -> Iterator[Element]:
        """All elements below, in document order."""
        waiting = [iter(self.inside)]
        while waiting:
            node = next(waiting[-1], None)
            if node is None:
                waiting.pop()
            elif isinstance(node, Element):
                yield node
                waiting.append(iter(node.inside))

    def first(self, holds: Callable[[Element], bool]) -> Element | None:
        return next((e for e in self.elements() if holds(e)), None)

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def texts(self) -> Iterator[str]:
        """All texts below, in document order."""
        waiting = [iter(self.inside)]
        while waiting:
            node = next(waiting[-1], None)
            if node is None:
                waiting.pop()
            elif isinstance(node, str):
                yield node
            else:
                waiting.append(iter(node.inside))

    def label(self) -> str:
        """Its own text first, then that of each element in it; blanks collapsed."""
        made: dict[int, str] = {}
        for e in [*list(self.elements())[::-1], self]:  # what is inside comes before
            own = [x for x in e.inside if isinstance(x, str) and x.strip()]
            made[id(e)] = " ".join(" ".join([*own, *(made[id(x)] for x in e.inside if isinstance(x, Element))]).split())
        return made[id(self)]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        made = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].inside.append(made)
        if tag not in VOID:
            self.open.append(made)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].inside.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        self.open[-1].inside.append(data)


def tree(markup: str) -> Element:
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


def latex(node: Element) -> str:
    """A MathML element as LaTeX; ValueError for what lacks an operand or isn't known."""
    parts = [x for x in node.inside if isinstance(x, Element)]

    def operands(n: int) -> list[str]:
        if len(parts) != n:
            raise ValueError(f"{node.tag} has {len(parts)} operands")
        return [latex(x) for x in parts]

    def every() -> str:
        return "".join(latex(x) for x in parts)

    match node.tag:
        case "mi" | "mn" | "mo" | "mtext" | "ms":
            text = "".join(node.texts()).strip()
            if node.tag == "mtext":
                return f"\\text{{{text}}}" if text else ""
            return f"{SIGNS[text]} " if text in SIGNS else text
        case "math" | "mrow" | "semantics" | "mstyle" | "mpadded" | "mtd":
            if any(isinstance(x, str) and x.strip() for x in node.inside):
                raise ValueError(f"text in {node.tag}")
            return every()
        case "mfrac":
            return "\\frac{%s}{%s}" % tuple(operands(2))
        case "msup":
            return "%s^{%s}" % tuple(operands(2))
        case "msub":
            return "%s_{%s}" % tuple(operands(2))
        case "msubsup":
            return "%s_{%s}^{%s}" % tuple(operands(3))
        case "munder":
            return "\\underset{%s}{%s}" % tuple(operands(2)[::-1])
        case "mover":
            return "\\overset{%s}{%s}" % tuple(operands(2)[::-1])
        case "munderover":
            base, low, high = operands(3)
            return f"{base.strip()}_{{{low}}}^{{{high}}}"
        case "msqrt":
            return f"\\sqrt{{{every()}}}"
        case "mroot":
            return "\\sqrt[%s]{%s}" % tuple(operands(2)[::-1])
        case "mfenced":
            between = (node.attrs.get("separators", ",").strip() or "")[:1]
            return f"\\left{node.attrs.get('open', '(')}{between.join(latex(x) for x in parts)}\\right{node.attrs.get('close', ')')}"
        case "mtable":
            return "\\begin{matrix}" + " \\\\ ".join(latex(x) for x in parts) + "\\end{matrix}"
        case "mtr":
            return " & ".join(latex(x) for x in parts)
        case "mspace" | "mphantom":
            return " "
    raise ValueError(f"unknown element {node.tag}")


def formula(node: Element, counts: Counter) -> str | None:
    """The LaTeX of a math element: its annotation, its alternative text, or converted; None if there is nothing in it."""
    note = node.first(lambda e: e.tag == "annotation" and e.attrs.get("encoding") == "application/x-tex")
    value = "".join(note.texts()) if note else node.attrs.get("alttext")
    if not value:
        plain = _without(node, lambda e: e.tag in ("annotation", "annotation-xml"))
        counts["math_spacing_removed"] += sum(e.tag == "mspace" for e in plain.elements())
        plain = _without(plain, lambda e: e.tag == "mspace")
        if not "".join(plain.texts()).strip() and all(e.tag in ("semantics", "mrow") for e in plain.elements()):
            counts["empty_math_placeholder_removed"] += 1
            return None
        try:
            value = latex(plain).strip()
            if not value:
                raise ValueError("nothing converted")
            counts["mathml_converted_to_latex"] += 1
        except (ValueError, RecursionError):
            value = UNCONVERTED
            counts["math_conversion_failed"] += 1
    for sign, written in UNSEEN.items():
        value = value.replace(sign, written)
    return value


def _without(node: Element, gone: Callable[[Element], bool]) -> Element:
    """A copy without the elements that ``gone`` names."""
    made = Element(node.tag, node.attrs)
    waiting = [(node, made)]
    while waiting:
        old, new = waiting.pop()
        for x in old.inside:
            if isinstance(x, str):
                new.inside.append(x)
            elif not gone(x):
                copy = Element(x.tag, x.attrs)
                new.inside.append(copy)
                waiting.append((x, copy))
    return made


@dataclass(frozen=True)
class Rules:
    """How a kind of page becomes text.

    ``dropped`` elements go with all in them and are counted as ``dropped_as``; ``silent`` ones go uncounted. ``brackets``
    stand around lowered and raised text. ``unwrap`` takes line feeds of the source as blanks.
    ``container`` finds the part that holds the text; a page without one, or one that ``shell``
    recognises, is an error.
    """

    dropped: Callable[[Element], bool]
    dropped_as: str
    blocks: frozenset[str]
    brackets: tuple[str, str]
    unwrap: bool = False
    math: bool = False
    shell: Callable[[Element], bool] | None = None
    container: Callable[[Element], Element | None] | None = None
    silent: Callable[[Element], bool] | None = None
    masked: bool = True


def _tags(*names: str) -> Callable[[Element], bool]:
    held = frozenset(names)
    return lambda e: e.tag in held


def _textbook_dropped(e: Element) -> bool:
    return e.tag in {"script", "style", "nav", "button", "iframe", "video", "audio", "svg", "figure"} or e.attrs.get("data-type") in ("figure", "media") or "os-figure" in e.classes()


def _textbook_container(root: Element) -> Element | None:
    main = root.first(lambda e: e.attrs.get("id") == "main-content")
    page = main and main.first(lambda e: e.attrs.get("data-type") == "page")
    return page or root.first(lambda e: e.attrs.get("data-book-content") == "true")


TEXTBOOK = Rules(
    _textbook_dropped, "media_or_ui_blocks", frozenset(TEXTBOOK_BLOCKS), ("(", ")"), math=True, container=_textbook_container,
    silent=lambda e: "MathJax" in e.classes() or e.tag == "mjx-container",
)
MODULE = Rules(
    _tags("script", "style", "nav", "figure", "img", "video", "audio", "iframe", "svg"), "media_or_ui_removed", frozenset(MODULE_BLOCKS), ("{", "}"), unwrap=True,
    shell=lambda e: e.tag in ("html", "body") or e.attrs.get("id") == "root" or e.tag == "form" and "login" in e.attrs.get("action", ""),
)
#: Any whole page: what is never read is dropped, and nothing is masked.
PAGE = Rules(
    _tags("script", "style", "nav", "figure", "img", "video", "audio", "iframe", "svg", "head", "noscript", "template", "button"), "media_or_ui_removed",
    frozenset(TEXTBOOK_BLOCKS | {"article", "main", "body", "header", "footer", "aside", "form", "pre", "figcaption"}), ("{", "}"), unwrap=True, masked=False,
)


def normal(text: str) -> str:
    """NFKC, no invisible or control characters, lines collapsed, at most one empty line in a row."""
    text = re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", unicodedata.normalize("NFKC", text).replace("​", "").replace("­", ""))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(re.sub("[ \t\xa0]+", " ", line).strip() for line in text.splitlines())).strip()


def page_text(markup: str, rules: Rules) -> tuple[str, dict[str, int]]:
    """The text of a page and what was removed, converted or masked on the way; ValueError for a page that the rules refuse."""
    root = tree(markup)
    if rules.shell and root.first(rules.shell):
        raise ValueError("a whole document or a login form in place of a fragment")
    if rules.container:
        root = rules.container(root)
        if root is None:
            raise ValueError("no container of the text")
    counts: Counter = Counter()
    out: list[str] = []

    def blank(text: str) -> str:
        return re.sub(r"\s+", " ", text) if rules.unwrap else text

    def write(node: Element) -> None:
        waiting: list[Iterator | str] = [iter(node.inside)]
        while waiting:
            if isinstance(waiting[-1], str):
                out.append(waiting.pop())
                continue
            x = next(waiting[-1], None)
            if x is None:
                waiting.pop()
            elif isinstance(x, str):
                out.append(blank(x))
            elif rules.dropped(x):
                counts[rules.dropped_as] += 1
            elif rules.math and x.tag == "math":
                if (value := formula(x, counts)) is not None:
                    out.append(f" ${value}$ ")
            elif rules.silent and rules.silent(x):
                for math in (e for e in x.elements() if rules.math and e.tag == "math"):
                    formula(math, counts)  # counted where it stands
            elif x.tag in ("sub", "sup"):
                inner = _without(x, lambda e: rules.dropped(e))
                counts[rules.dropped_as] += sum(rules.dropped(e) for e in x.elements())
                out.append(("_" if x.tag == "sub" else "^") + rules.brackets[0] + "".join(_flat(inner, rules, counts, blank)) + rules.brackets[1])
            elif x.tag in ("br", "hr"):
                out.append("\n")
            else:
                around = "\n\n" if x.tag in rules.blocks else ""
                out.append(around)
                waiting += [around, " | " if x.tag in ("td", "th") else "", iter(x.inside)]

    write(root)
    text = normal("".join(out))
    if rules.masked:
        for name, pattern in MASKED:
            text, n = pattern.subn(f"[REDACTED:{name.upper()}]", text)
            counts[name] += n
    return text, {k: n for k, n in counts.items() if n}


def _flat(node: Element, rules: Rules, counts: Counter, blank: Callable[[str], str]) -> Iterator[str]:
    """The plain text of a lowered or raised element, formulas converted."""
    for x in node.inside:
        if isinstance(x, str):
            yield blank(x)
        elif rules.math and x.tag == "math":
            if (value := formula(x, counts)) is not None:
                yield f" ${value}$ "
        else:
            yield from _flat(x, rules, counts, blank)


PAGE_TEXT = StructType([StructField("text", StringType()), StructField("counters", MapType(StringType(), IntegerType())), StructField("error", StringType())])


def page_column(rules: Rules):
    """A pandas UDF: struct of text, counters and error. Null gives nulls; a page that is refused has an error and no text."""

    @F.pandas_udf(PAGE_TEXT)
    def read(markup: pd.Series) -> pd.DataFrame:
        rows = []
        for page in markup:
            if page is None:
                rows.append((None, None, None))
                continue
            try:
                rows.append((*page_text(page, rules), None))
            except (ValueError, RecursionError, AssertionError) as error:  # the last: broken declarations
                rows.append((None, None, str(error) or type(error).__name__))
        return pd.DataFrame(rows, columns=["text", "counters", "error"])

    return read


def projects_of(markup: str | None, base: str) -> Iterator[tuple]:
    """Rows of the list table: those with five cells or more whose first holds a link to a project."""
    table = tree(markup or "").first(lambda e: e.tag == "table" and e.attrs.get("id") == "table")
    for row in table.elements() if table else ():
        cells = [x for x in row.inside if isinstance(x, Element) and x.tag == "td"] if row.tag == "tr" else []
        link = cells[0].first(lambda e: e.tag == "a" and "/projekt/" in e.attrs.get("href", "")) if len(cells) >= 5 else None
        number = re.search(r"/projekt/(\d+)", link.attrs["href"]) if link else None
        if number:
            others = [cell.first(lambda e: e.tag == "a") for cell in cells[1:3]]
            applicant, code = ((a or cell).label() for a, cell in zip(others, cells[1:3]))
            code_url = urljoin(base, others[1].attrs.get("href", "")) if others[1] else ""
            yield number[1], link.label(), urljoin(base, link.attrs["href"]), applicant, code, code_url, cells[3].label(), cells[4].label()


def documents_of(markup: str | None, base: str) -> Iterator[tuple]:
    """Documents of a catalogue: the items with a link to a document, in boxes that name a category."""
    for box in tree(markup or "").elements():
        head = box.first(lambda e: e.tag == "li" and "childdir" in e.classes()) if box.tag == "div" and "clearbox" in box.classes() else None
        if head is None:
            continue
        category = re.sub(r"Data ostatniej modyfikacji:.*$", "", head.label()).strip()
        for item in box.elements():
            link = item.first(lambda e: e.tag == "a" and "/docs/" in e.attrs.get("href", "")) if item.tag == "li" and "doc" in item.classes() else None
            if link is None:
                continue
            whole = item.label()
            author = re.search(r"Autor dokumentu:\s*(.*?)(?:,\s*wprowadzony przez:|Data utworzenia:|$)", whole)
            created = re.search(r"Data utworzenia:\s*(\d{2}-\d{2}-\d{4})", whole)
            yield head.attrs.get("id", ""), category, link.label(), urljoin(base, link.attrs["href"]), " ".join(author[1].strip(" ,").split()) if author else "", created[1] if created else ""


def anchors_of(markup: str | None, base: str | None) -> Iterator[tuple]:
    """Links in document order: place, whole address without fragment, label, and whether it stays on the host."""
    found = (e for e in tree(markup or "").elements() if e.tag == "a" and e.attrs.get("href"))
    for k, link in enumerate(found):
        whole = urlsplit(urljoin(base or "", link.attrs["href"]))._replace(fragment="")
        yield k, whole.geturl(), link.label(), whole.netloc == urlsplit(base or "").netloc


#: Table functions by name: what they make of a page and its address, and their columns.
TABLE_FUNCTIONS = {
    "listed_projects": (projects_of, "project_id string, title string, project_url string, applicant string, number string, number_url string, created string, modified string"),
    "catalogued_documents": (documents_of, "category_id string, category string, filename string, document_url string, author string, created string"),
    "page_anchors": (anchors_of, "place int, address string, label string, same_host boolean"),
}


def register(spark: SparkSession) -> None:
    """Make TABLE_FUNCTIONS known to SQL, for ``pages, LATERAL name(html, url)``. A page that can't be read gives no row."""
    for name, (rows, columns) in TABLE_FUNCTIONS.items():

        class Reader:
            def eval(self, markup: str, base: str, rows=rows):
                try:
                    yield from rows(markup, base or "")
                except (ValueError, AssertionError):  # an address or a declaration that is none
                    return

        spark.udtf.register(name, F.udtf(Reader, returnType=columns))
