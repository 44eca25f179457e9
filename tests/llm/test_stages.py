"""The pipeline's stages against brute force on small tables with the hard cases."""

import itertools

import corpus_pipeline
from corpusflow.llm import op4_language, op6_pii
from corpusflow.session import ship_package

#: Names that the operators use themselves.
CLASH = ("doc", "_gone", "score", "accepted", "lang_pred", "lines", "own", "text_md5", "component", "kept", "_range", "id", "best", "times")
SHAPE = "doc_id long, text string, lang string, n_chars int, " + ", ".join(f"`{c}` string" for c in CLASH)


def frame(spark, rows):
    """``rows`` of (doc_id, text, lang); every clashing column says which row it is of."""
    ship_package(spark)
    return spark.createDataFrame([(i, t, lang, len(t or ""), *[f"{c}-{k}" for c in CLASH]) for k, (i, t, lang) in enumerate(rows)], SHAPE)


def clashes(row):
    return tuple(row[c] for c in CLASH)


def test_language_keeps_own_columns_and_drops_rejected_rows(spark):
    words = {"en": "the quick river and small house of the stone", "de": "der schnelle Fluss und das kleine Haus aus dem Stein"}
    rows = [(k, f"{words[lang]} {k % 7} {words[lang][k % 9:]}", lang) for k in range(120) for lang in ("en", "de")]
    rows += [(500, None, "en"), (501, "", None), (502, "12 34", "de"), (503, "  ", "de"), (None, words["en"], None), (7, words["en"], "en")]
    df = frame(spark, rows)
    plain = df.select("doc_id", "text", "lang", "doc")
    want = [r.doc for r in op4_language.predict(plain, op4_language.fit(plain)).where("accepted").collect()]
    got = corpus_pipeline.language(spark, df, "")
    assert got.schema.fieldNames() == df.columns and [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    before = {r.doc: r for r in df.collect()}
    rows_ = got.collect()
    assert sorted(r.doc for r in rows_) == sorted(want) and all(r == before[r.doc] for r in rows_)
    assert not {500, 501, 502, 503} & {r.doc_id for r in rows_} and len(rows_) > 200
    assert corpus_pipeline.language(spark, df.limit(0), "").count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lines_keep_own_columns_and_equal_all_pairs(spark):
    line = "this is a long line of boilerplate number"
    rows = [(3, f"{line} 17\nonly here, with some words\n\nend", "x"), (1, f"{line} 18\nend", "x"), (2, None, "x"), (4, "", "x"),
            (5, f"{line} 777\n{line}\nsomething else again", "x"), (6, f"{line} 18\n{line} 17", "x"), (6, f"{line} 18\n{line} 17", "x")]
    df = frame(spark, rows)
    seen, want = [], {}
    for i, t, _ in sorted(set(rows), key=lambda r: r[0]):
        kept = []
        for x in (t or "").split("\n"):
            if x.strip() and any(x == y or len(x) >= 16 and len(y) >= 16 and _distance(x, y) <= 2 for y in seen):
                continue
            kept.append(x)
        seen += [x for x in (t or "").split("\n") if x.strip()]
        want[i] = None if t is None else "\n".join(kept)
    got = corpus_pipeline.lines(spark, df, "")
    assert got.columns == df.columns
    before = {r.doc: r for r in df.collect()}
    rows_ = got.collect()
    assert len(rows_) == len(rows)
    for r in rows_:
        assert r.text == want[r.doc_id] and clashes(r) == clashes(before[r.doc])
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert corpus_pipeline.lines(spark, df.limit(0), "").count() == 0


def _groups(rows):
    """Component of each row: sets of five-word shingles alike by 80 percent, or one doc_id."""
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets, top = [shingles(t) for _, t, _ in rows], list(range(len(rows)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for x, y in itertools.combinations(range(len(rows)), 2):
        p, q = sets[x], sets[y]
        if p and q and (100 * len(p & q) >= 80 * len(p | q) or rows[x][0] is not None and rows[x][0] == rows[y][0]):
            top[max(root(x), root(y))] = min(root(x), root(y))
    return [root(k) if sets[k] else None for k in range(len(rows))]


def test_near_duplicates_keep_one_row_of_each_group(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(100)) for x in "abcd")
    rows = [(1, a), (1, a), (2, a), (None, a), (None, a), (3, b + " x y"), (4, b), (7, c), (7, d), (8, d + " z"), (9, "q r"), (10, "q r"), (11, ""), (11, ""),
            (12, None), (None, "lone words of a text without id"), (None, "lone words of a text without id"), (None, ""), (13, a.upper()), (14, "own text")]
    rows = [(i, t, "x") for i, t in rows]
    df = frame(spark, rows)
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns
    kept = sorted(int(r.doc.split("-")[1]) for r in got.collect())
    groups = _groups(rows)
    assert [k for k in kept if groups[k] is None] == [k for k, g in enumerate(groups) if g is None]
    with_words = [k for k in kept if groups[k] is not None]
    assert sorted(groups[k] for k in with_words) == sorted({g for g in groups if g is not None})
    for k in with_words:
        ids = [rows[j][0] for j, g in enumerate(groups) if g == groups[k] and rows[j][0] is not None]
        assert rows[k][0] == (min(ids) if ids else None)
    before = {r.doc: r for r in df.collect()}
    assert all(r == before[r.doc] for r in got.collect())
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


def test_personal_data_stage_equals_the_spans(spark):
    rows = [(1, "mail joe@host dot co dot uk or joe@host.org", "x"), (1, "call +1 614 555 8001", "x"), (None, "10.0.0.1", "x"), (2, None, "x"), (3, "", "x"), (4, "no data", "x")]
    df = frame(spark, rows)
    before = {r.doc: r for r in df.collect()}
    got = corpus_pipeline.personal_data(spark, df, "").collect()
    assert len(got) == len(rows)
    for r in got:
        old = before[r.doc].text
        assert r.text == (old and op6_pii.redact(old, op6_pii.spans(old)[1])) and clashes(r) == clashes(before[r.doc])
    assert {r.text for r in got} == {"mail [EMAIL] or [EMAIL]", "call [PHONE]", "[IP]", None, "", "no data"}
