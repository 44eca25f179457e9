"""Titles and HTML text, with the reference's test cases as golden inputs."""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions.html import html_text, html_title, parse_text
from corpusflow.operators.extract import assemble_cells, assemble_pages, assemble_paragraphs, assemble_shapes, extract_documents

FILES = [
    ("readme.md", "# My Project\n\nSome content here.", "My Project"),
    ("guide.rst", "User Guide\n==========\n\nWelcome.", "User Guide"),
    ("ops.adoc", "= Operations Manual\n\nFirst section.", "Operations Manual"),
    ("changelog.txt", "Line one\nLine two", "changelog"),
    ("notes.md", "No heading here", "notes"),
    ("deep.md", "## Second level\ntext", "deep"),
    ("hash.md", "# # odd", "hash"),
    ("empty.txt", "", "empty"),
    ("page.html", "<html><head><title>My Page</title></head><body><p>Hello</p></body></html>", "My Page"),
    ("bare.html", "<html><body><p>Hi</p></body></html>", "bare"),
    ("data.bin", "\x00\x01", ""),
    ("rst2.rst", "\n\nTitle\n-----\ntext", "Title"),
    ("rst4.rst", "Title\n---\ntext", "rst4"),
    ("rst3.rst", "Long title\n===\n", "rst3"),
]


def test_titles_and_fallbacks(spark):
    df = spark.createDataFrame([(n, c) for n, c, _ in FILES], "name string, content string")
    got = {r["name"]: r for r in extract_documents(df).collect()}
    for n, c, title in FILES:
        assert got[n]["title"] == title, n
    assert got["data.bin"]["text"] == ""
    assert got["empty.txt"]["text"] == ""
    assert got["page.html"]["text"] == "My Page\nHello"


HTML_CASES = [
    ("<nav><ul><li>a</li></ul>b</nav>c", "a\nb\nc"),
    ("<header>h<b>bold</b>t</header>z", "bold\nt\nz"),
    ("<script>var x = '<p>';</script>after", "after"),
    ("<main>keep</main><footer>drop</footer>tail", "keep\ntail"),
    ("<title>A&amp;B</title>", "A&B"),
    ("1 < 2 and 3", "1\n<\n2 and 3"),
]


@pytest.mark.parametrize("html,want", HTML_CASES)
def test_exact_parser_rules(html, want):
    assert parse_text(html) == want


MORE_CASES = HTML_CASES + [
    ("<nav></p>a</nav>b", "b"),
    ("<nav>a<!-- c -->b</nav>c", "c"),
    ("<footer>x</span>y<b>z</b>", "z"),
    ("<p>keep<!-- hidden --> more</p>", "keep\nmore"),
    ("<p>&copy; &mdash; &#x27;q&#x27;</p>", "\u00a9 \u2014 'q'"),
    ("<p>a &#390; b</p>", "a \u0186 b"),
    ("<p>&ltimes;</p>", "\u22c9"),
    ("<!-- <script> --> visible <script>x</script> end<br>", "visible\nend"),
    ('<script>var a="</style>"; leak()</script>z<br>', "z"),
    ('<a title="x>y">link</a>', "link"),
]


def test_html_text_column(spark):
    df = spark.createDataFrame([(h,) for h, _ in MORE_CASES] + [(None,)], "h string")
    assert [r["t"] for r in df.select(html_text("h").alias("t")).collect()] == [w for _, w in MORE_CASES] + [None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    ["<nav>", "</nav>", "<p>", "</p>", "<script>", "</script>", "<!--", "-->", "text", " a < b ", "&amp;", "&#390;", "&copy", '<a t="x>y">', "</", "<footer/>"]
), max_size=12))
def test_html_text_against_the_tokenizer(parts):
    """A plain second form: what the tokenizer reports, with the flag kept as text arrives."""
    from html.parser import HTMLParser

    hidden, kept = [False], []
    parser = HTMLParser()
    listed = ("script", "style", "nav", "header", "footer")
    parser.handle_starttag = lambda tag, attrs: hidden.__setitem__(0, tag in listed)
    parser.handle_endtag = lambda tag: hidden.__setitem__(0, hidden[0] and tag not in listed)
    parser.handle_data = lambda data: kept.append("" if hidden[0] else data.strip())
    parser.feed("".join(parts))
    assert parse_text("".join(parts)) == "\n".join(x for x in kept if x)


def test_extraction_keeps_files_apart(spark):
    df = spark.createDataFrame(
        [("x/a.pdf", "a.pdf", "one\ntwo", " Meta "), ("y/a.pdf", "a.pdf", "", None), ("n.pdf", "n.pdf", None, ""),
         ("n.md", "n.md", None, None), ("n.html", "n.html", None, None), ("s.xlsx", "s.xlsx", "a, b\n\nc", "unused"),
         ("d.docx", "d.docx", "p\n \nq", "T")],
        "path string, name string, content string, meta string",
    )
    from corpusflow.operators.extract import extract_documents as run

    got = {r["path"]: (r["text"], r["title"]) for r in run(df, title="meta", keep=("path",)).collect()}
    assert got == {
        "x/a.pdf": ("one\n\ntwo", "Meta"), "y/a.pdf": ("", "a"), "n.pdf": ("", "n"), "n.md": ("", ""),
        "n.html": ("", "n"), "s.xlsx": ("a | b\n\nc", "s"), "d.docx": ("p\n\nq", "T"),
    }
    plan = run(df, keep=("path",))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_html_title_keeps_entities(spark):
    df = spark.createDataFrame([("<TITLE a=1>\n A&amp;B \n</title>",), ("<p>none</p>",)], "h string")
    assert [r["t"] for r in df.select(html_title("h").alias("t")).collect()] == ["A&amp;B", ""]


def test_parts_assembly(spark):
    parts = spark.createDataFrame(
        [(1, 2, "p2"), (1, 0, "p0"), (1, 1, None), (2, 0, "  "), (2, 1, " x ")], "doc int, ord int, text string"
    )
    pages = {r["doc"]: r["text"] for r in assemble_pages(parts).collect()}
    assert pages[1] == "p0\n\n\n\np2"
    paras = {r["doc"]: r["text"] for r in assemble_paragraphs(parts).collect()}
    assert paras[1] == "p0\n\np2" and paras[2] == " x "
    cells = spark.createDataFrame(
        [(1, 0, 0, 1, "Item"), (1, 0, 0, 2, "Cost"), (1, 0, 1, 1, "Widget"), (1, 0, 1, 2, "42"), (1, 0, 2, 1, None)],
        "doc int, sheet int, row int, col int, value string",
    )
    assert assemble_cells(cells).first()["text"] == "Item | Cost\nWidget | 42"


def test_duckdb_sketch_equals_native_on_sample(spark):
    from corpusflow.plans.oracle_sql import html_text as sql_html_text

    got = {r["page_id"]: r["t"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
           .select("page_id", html_text("html").alias("t")).collect()}
    con = duckdb.connect()
    q = f"SELECT page_id, {sql_html_text('html', 'chr(10)')} AS t FROM '/root/testdata/sf0.001/pages.parquet'"
    for pid, t in con.execute(q).fetchall():
        assert got[pid] == t


def test_scan_tree_on_storage(spark, tmp_path):
    from corpusflow.sources.scans import read_text, scan_tree

    (tmp_path / "docs" / "a").mkdir(parents=True)
    (tmp_path / "docs" / "a" / "x.md").write_bytes(b"# X\r\nbody\xff")
    (tmp_path / "docs" / "y.TXT").write_text("y")
    (tmp_path / "docs" / "z.bin").write_text("z")
    (tmp_path / "top.md").write_text("t")
    got = {r["path"]: r["text"] for r in read_text(scan_tree(spark, str(tmp_path), "docs/**/*")).collect()}
    assert got == {"docs/a/x.md": "# X\nbody�", "docs/y.TXT": "y"}
    assert scan_tree(spark, f"file://{tmp_path}/", "docs/**/*").count() == 2
    allmd = {r["path"] for r in scan_tree(spark, str(tmp_path), "**/*.md").collect()}
    assert allmd == {"docs/a/x.md", "top.md"}


def test_pages_of_both_kinds(spark):
    from corpusflow.sources.scans import scan_pages

    pages = spark.createDataFrame(
        [("u1", "text/html", "<nav></p>a</nav>b<br>"), ("u2", "text/plain", "plain"), ("u3", None, " "), ("u4", "text/html", None)],
        "url string, content_type string, body string",
    )
    got = {r["source"]: r["text"] for r in scan_pages(pages).collect()}
    assert got == {"u1": "b", "u2": "plain"}


def test_long_inputs_do_not_overflow_the_regex_stack(spark):
    from corpusflow.functions.titles import first_line_title

    page = "<p>a</p><nav>" + ("word " * 60000) + "</nav><p>tail</p><!--" + ("c" * 200000) + "-->end<br>"
    line = "# " + ("x" * 300000) + "\nrest"
    df = spark.createDataFrame([(page, line)], "h string, m string")
    r = df.select(html_text("h").alias("t"), first_line_title("m").alias("ti")).first()
    assert r["t"] == "a\ntail\nend" and len(r["ti"]) == 300000


def test_parse_url_list_and_invalid_config(spark):
    from corpusflow.sources.scans import parse_repo_specs, parse_url_list

    cfg = spark.createDataFrame([(1, '["https://a.example/x", "https://b.example/y"]'), (2, "not json")], "k int, config string")
    assert [(r["k"], r["url"]) for r in parse_url_list(cfg).orderBy("k", "pos").collect()] == [
        (1, "https://a.example/x"), (1, "https://b.example/y")
    ]
    specs = spark.createDataFrame([(1, '[{"url": "https://g/r.git"}, {"glob": "*.md"}, {"url": ""}]')], "k int, config string")
    assert [(r["url"], r["glob"]) for r in parse_repo_specs(specs).collect()] == [("https://g/r.git", "**/*")]


def _parts_frame(spark):
    """A document of 6,000 parts with unevenly spread orders, 300 of five parts, one without an id."""
    big = spark.range(6000).select(F.lit(7).alias("doc"), (F.col("id") * F.col("id")).alias("ord"), F.col("id").alias("n"))
    few = spark.range(1500).select((100 + F.floor(F.col("id") / 5)).cast("int").alias("doc"), (F.col("id") % 5).alias("ord"), F.col("id").alias("n"))
    none = spark.range(50).select(F.lit(None).cast("int").alias("doc"), F.col("id").alias("ord"), F.col("id").alias("n"))
    text = F.when(F.col("n") % 7 == 3, F.lit(None)).when(F.col("n") % 7 == 5, F.lit("")).when(F.col("n") % 7 == 6, F.lit(" \t")).otherwise(F.concat(F.lit("p"), "n"))
    rows = big.union(few).union(none).withColumn("text", text).withColumn("has_text", F.col("n") % 3 != 0)
    return rows.repartition(8, F.xxhash64("n"))


@pytest.mark.parametrize("most", [1, 40, 1000, 5999])
def test_huge_documents_are_joined_by_ranges(spark, most):
    parts = _parts_frame(spark).persist()
    by_doc = {}
    for r in sorted(parts.collect(), key=lambda r: r["ord"]):
        by_doc.setdefault(r["doc"], []).append((r["text"], r["has_text"]))
    want = {
        assemble_pages: lambda rows: "\n\n".join(t or "" for t, _ in rows),
        assemble_paragraphs: lambda rows: "\n\n".join(t for t, _ in rows if t is not None and t.strip()),
        assemble_shapes: lambda rows: "\n\n".join(t or "" for t, has in rows if has),
    }
    for run, text in want.items():
        got = {r["doc"]: r["text"] for r in run(parts, most=most).collect()}
        assert got == {doc: text(rows) for doc, rows in by_doc.items()}, run
    parts.unpersist()


def test_a_huge_document_does_not_meet_in_one_list(spark):
    """Only joined ranges reach the document's group, a few rows of the 6,000."""
    plan = assemble_pages(_parts_frame(spark), most=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") >= 1 and "_range" in plan
    small = assemble_pages(_parts_frame(spark), most=6000)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in small and "Join" not in small


def test_huge_workbook(spark):
    cells = spark.range(9000).select(
        F.lit("wb").alias("doc"), (F.col("id") % 3).alias("sheet"), F.floor(F.col("id") / 9).alias("row"), (F.floor(F.col("id") / 3) % 3).alias("col"),
        F.when(F.floor(F.col("id") / 9) % 10 == 4, F.lit(None)).otherwise(F.col("id").cast("string")).alias("value"))
    plain = assemble_cells(cells).first()["text"]
    assert assemble_cells(cells, most=100).first()["text"] == plain
    assert len(plain.split("\n")) == 2700 and plain.startswith("0 | 3 | 6\n9 | 12 | 15\n")


def test_empty_parts(spark):
    parts = spark.createDataFrame([], "doc int, ord int, text string")
    assert assemble_pages(parts, most=1).count() == 0


def test_metadata_titles(spark):
    files = [("a.pdf", " Annual "), ("b.docx", "  "), ("c.pptx", None), ("d.xlsx", "ignored"), ("e.md", "ignored")]
    df = spark.createDataFrame([(n, "x", t) for n, t in files], "name string, content string, stated string")
    got = {r["name"]: r["title"] for r in extract_documents(df, title="stated").collect()}
    assert got == {"a.pdf": "Annual", "b.docx": "b", "c.pptx": "c", "d.xlsx": "d", "e.md": "e"}
