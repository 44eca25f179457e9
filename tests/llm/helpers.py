"""Small documents with the hard cases, shared by the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, spans long, `kept` string"


def rows(n=60, seed=1):
    """Prose with copies, near copies, repeated lines, nulls, blanks, odd characters and a long text."""
    rng = random.Random(seed)
    words = ["the", "of", "and", "house", "Über", "été", "river", "stone", "wind", "le", "der", "small", "tree", "123", "x|y", "walks"]
    lines = [" ".join(rng.choice(words) + rng.choice(["", str(rng.randint(0, 99))]) for _ in range(rng.randint(4, 30))) for _ in range(40)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " end", None, "", " \n\t ", "|||", "one", "one two", "a\x1cb c\xa0d 漢字 ▁ x", "ab " * 20_000,
              "mail joe@host.example.org or +1 (614) 555-8001 at 10.0.0.1", "joe [at] host [dot] org"]
    langs = ["en", "fr", None]
    return [(k, t, langs[k % 3], "s", len(t or ""), "clash", 1, "clash") for k, t in enumerate(texts)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)
