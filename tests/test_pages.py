"""Golden pages: texts, formulas, listings and catalogues."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import markup, pages
from corpusloom.operators.contracts import counter_totals

BOOK = '<div id="main-content"><div data-type="page">%s</div></div>'


def book(inside):
    return pages.page_text(BOOK % inside, pages.TEXTBOOK)


def module(text):
    return pages.page_text(text, pages.MODULE)


def test_paragraphs_and_containers():
    assert book("<h2>Tytul</h2><p>To <b>jest</b> polski tekst.</p><p>Drugi akapit.</p>")[0] == "Tytul\n\nTo jest polski tekst.\n\nDrugi akapit."
    assert pages.page_text("<nav>MENU</nav>" + BOOK % "<p>Tekst</p>" + "<footer>Footer</footer>", pages.TEXTBOOK)[0] == "Tekst"
    assert pages.page_text('<p>x</p><div data-book-content="true">In</div>', pages.TEXTBOOK)[0] == "In"
    with pytest.raises(ValueError):
        pages.page_text("<html>Access denied</html>", pages.TEXTBOOK)


def test_formulas():
    text, counts = book('<figure><p>Picture credit</p></figure><p>Wzor: <math><semantics><mi>x</mi><annotation encoding="application/x-tex">x^2</annotation></semantics></math>.</p><p>Kontakt: test@example.com, tel. 123 456 789</p>')
    assert text == "Wzor: $x^2$ .\n\nKontakt: [REDACTED:EMAIL], [REDACTED:LABELLED_PHONE]"
    assert counts == {"media_or_ui_blocks": 1, "email": 1, "labelled_phone": 1}
    text, counts = book("<math><semantics><mfrac><mi>a</mi><msup><mi>b</mi><mn>2</mn></msup></mfrac><annotation-xml><mi>duplicate</mi></annotation-xml></semantics></math>")
    assert text == "$\\frac{a}{b^{2}}$" and counts == {"mathml_converted_to_latex": 1}
    text, counts = book('<math><semantics><mrow></mrow></semantics></math><math><msup><mn>10</mn><mn>7</mn><mspace width="0.2em"/></msup></math>')
    assert text == "$10^{7}$" and counts == {"empty_math_placeholder_removed": 1, "math_spacing_removed": 1, "mathml_converted_to_latex": 1}
    text, counts = book("<math><msup><mi>s</mi></msup></math>")
    assert text == "$[UNCONVERTED_MATHML]$" and counts == {"math_conversion_failed": 1}
    assert book('<math alttext="a⁢b"><mi>q</mi></math>')[0] == "$a \\cdot b$"
    assert book('<span class="MathJax">twice</span><mjx-container>again</mjx-container>x<sub>i<sup>2</sup></sub>')[0] == "x_(i2)"


@pytest.mark.parametrize("mathml, want", [
    ("<msubsup><mi>x</mi><mn>1</mn><mn>2</mn></msubsup>", "x_{1}^{2}"), ("<msqrt><mi>a</mi><mo>+</mo><mi>b</mi></msqrt>", "\\sqrt{a+b}"), ("<mroot><mi>a</mi><mn>3</mn></mroot>", "\\sqrt[3]{a}"),
    ("<munderover><mo>∑</mo><mi>i</mi><mi>n</mi></munderover>", "\\sum_{i}^{n}"), ("<mfenced><mi>a</mi><mi>b</mi></mfenced>", "\\left(a,b\\right)"), ("<mi>α</mi><mo>≤</mo><mn>1</mn>", "\\alpha \\leq 1"),
    ("<mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr><mtr><mtd><mn>3</mn></mtd><mtd><mn>4</mn></mtd></mtr></mtable>", "\\begin{matrix}1 & 2 \\\\ 3 & 4\\end{matrix}"),
    ("<mover><mi>x</mi><mo>→</mo></mover>", "\\overset{\\rightarrow }{x}"), ("<mtext>if</mtext><mi>x</mi>", "\\text{if}x"), ("<strange/><mi>x</mi>", pages.UNCONVERTED), ("loose", pages.UNCONVERTED),
])
def test_conversion(mathml, want):
    assert book(f"<math>{mathml}</math>")[0] == f"${want}$"


def test_fragments():
    assert module("Pierwsza\nlinia.<p>To <b>jest</b>\n tekst.</p><p>Drugi.</p>")[0] == "Pierwsza linia.\n\nTo jest tekst.\n\nDrugi."
    text, counts = module(r'<figure><img src="x"><figcaption>Remove</figcaption></figure><p>Woda: <span>\(\ce{H_2O}\)</span> H<sub>2</sub>O.</p><table><tr><td>A</td><td>B</td></tr></table><!-- no --><p>a@example.com</p>')
    assert text == "Woda: \\(\\ce{H_2O}\\) H_{2}O.\n\nA | B |\n\n[REDACTED:EMAIL]" and counts == {"media_or_ui_removed": 1, "email": 1}
    for shell in ("<html><body>Login</body></html>", '<div id="root"></div>', '<form action="/user/login"><input></form>'):
        with pytest.raises(ValueError):
            module(shell)
    assert module("a<hr>b<aside>c</aside><form>d</form>")[0] == "a\nbcd"


def test_whole_pages():
    page = "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><header>Top</header><article><h1>H</h1><p>One<br>two<hr>three</p><figure><figcaption>no</figcaption></figure><table><tr><td></td><td>z</td></tr></table></article><footer>End</footer></body></html>"
    assert markup.text_of_html(page) == "Top\n\nH\n\nOne\ntwo\nthree\n\n| z |\n\nEnd"
    assert markup.text_of_html("<p>a" * 3000 + "</div>" * 10) == "\n\n".join("a" * 3000)


def test_column_and_counters(spark):
    rows = spark.createDataFrame([(1, BOOK % "<math><mi>x</mi></math>"), (2, "<p>none</p>"), (3, None), (4, BOOK % "<math><msup/></math> a@b.pl")], "id int, html string")
    read = rows.select("id", pages.page_column(pages.TEXTBOOK)("html").alias("p")).select("id", "p.*")
    assert {r["id"]: (r["text"], r["error"]) for r in read.collect()} == {1: ("$x$", None), 2: (None, "no container of the text"), 3: (None, None), 4: ("$[UNCONVERTED_MATHML]$ [REDACTED:EMAIL]", None)}
    assert {r["key"]: r["total"] for r in counter_totals(read, "counters").collect()} == {"mathml_converted_to_latex": 1, "math_conversion_failed": 1, "email": 1}


LIST = """<table id="table"><tr><th>Tytuł</th></tr>
<tr><td><a href="/projekt/123"> Ustawa  o <b>x</b></a></td><td><a href="#">Minister</a></td><td><a href="/nr/1">UD1</a></td><td>01-02-2026</td><td>03-02-2026</td></tr>
<tr><td><a href="/projekt/77/katalog">Bez linków</a><td>Rząd</td><td>UD2</td><td>x</td><td>y</td></tr>
<tr><td>bez linku</td><td>a</td><td>b</td><td>c</td><td>d</td></tr><tr><td><a href="/projekt/9">krótki</a></td></tr><tr><td><a href="/projekt/abc">nie</a></td><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"""
CATALOGUE = """<div class="box clearbox"><ul><li class="childdir" id="55">Projekt Data ostatniej modyfikacji: 01-01-2026</li>
<li class="doc"><a href="/docs/2/1.pdf">Projekt ustawy</a> Autor dokumentu: Jan  Nowak, wprowadzony przez: X Data utworzenia: 12-01-2026</li>
<li class="doc"><a href="/other">nie</a></li><li class="doc odd"><a href="/docs/3.docx">OSR</a></li></ul></div><div class="clearbox"><li class="doc"><a href="/docs/4">bez kategorii</a></li></div>"""


def test_table_functions(spark):
    pages.register(spark)
    spark.createDataFrame([(1, "https://h.pl/lista", LIST), (2, "https://h.pl/", CATALOGUE), (3, "https://h.pl/", "<table id=table><tr><td"), (4, None, None)], "page_id int, url string, html string").createOrReplaceTempView("golden")
    found = spark.sql("SELECT page_id, t.* FROM golden, LATERAL listed_projects(html, url) t ORDER BY project_id").collect()
    assert [tuple(r) for r in found] == [
        (1, "123", "Ustawa o x", "https://h.pl/projekt/123", "Minister", "UD1", "https://h.pl/nr/1", "01-02-2026", "03-02-2026")
    ]  # an unclosed cell holds those behind it, so that row has one cell
    found = spark.sql("SELECT page_id, t.* FROM golden, LATERAL catalogued_documents(html, url) t ORDER BY filename").collect()
    assert [tuple(r) for r in found] == [
        (2, "55", "Projekt", "OSR", "https://h.pl/docs/3.docx", "", ""),
        (2, "55", "Projekt", "Projekt ustawy", "https://h.pl/docs/2/1.pdf", "Jan Nowak", "12-01-2026"),
    ]
    found = spark.sql("SELECT place, address, label, same_host FROM golden, LATERAL page_anchors(html, url) WHERE page_id = 2 ORDER BY place").collect()
    assert [tuple(r) for r in found][:2] == [(0, "https://h.pl/docs/2/1.pdf", "Projekt ustawy", True), (1, "https://h.pl/other", "nie", True)]
    assert spark.table("golden").lateralJoin(spark.tvf.explode(F.array(F.lit(1)))).count() == 4
