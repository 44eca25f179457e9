"""Operators 11 to 13 against brute force and the tokenizer libraries, on small tables with the hard cases."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers as tokenizer_files
import pytest

from corpusflow.llm import catalog, op11_negatives as op11, op12_alignment as op12, op13_bytes as op13
from corpusflow.llm.common import stored
from corpusflow.llm.tokens import file_bytes
from corpusflow.session import ship_package
from tests.conftest import SF_SMALL
from tests.llm.helpers import frame, rows

ODD = ["\r", "a \r\n b", "x\n\n\ny", " \n ", "a\n  b\t\tc  ", "▁", "a▁b", "<s> <|endoftext|> <0x0A>", "\x1c \x85\xa0　z", "Ω" * 300, "aaaa" * 500,
       "😀🏳️‍🌈 漢字かな", "we'll they're 123٣４ x;\r\n}", "\U000323b0\U00032000 \U00010940q", "=" * 2_000, " " * 200 + "x", "\n" * 50]


@pytest.fixture(scope="module")
def data():
    base = rows()
    more = [(1_000 + k, t, None, None, len(t), "clash", 1, "clash") for k, t in enumerate(ODD)]
    return [*base, *more, base[3], base[3], (None, "no id here", "en", "s", 10, "clash", 1, "clash")]


@pytest.fixture(scope="module")
def docs(spark, data):
    ship_package(spark)
    return frame(spark, data).cache()


# --- 13: byte-level BPE ---------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    with open(tokenizer_files.path("byte_bpe_multi_50k.tiktoken"), "rb") as fh:
        return op13.rank_file(fh.read())


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenizer_files.PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_op13_table_equals_the_library(spark, docs, data, library):
    raw = file_bytes(spark, tokenizer_files.path("byte_bpe_multi_50k.tiktoken"))
    got = op13.decode(op13.encode(docs, raw), raw).collect()
    want = [(r[0], packed(library.encode_ordinary(r[1] or "")), r[1] or "") for r in data]
    assert collections.Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == collections.Counter(want)
    assert op13.decode(op13.encode(docs.limit(0), raw), raw).collect() == []


def test_op13_query_digests(spark, library):
    ship_package(spark)
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    found = catalog.queries()["op13_byte_bpe"](spark, SF_SMALL).collect()
    assert len(found) == len(text)
    for r in found:
        ids = library.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_op13_random_texts_with_few_states(ranks, library, monkeypatch):
    monkeypatch.setattr(op13, "STATES", 50)  # states start anew inside units
    monkeypatch.setattr(op13, "LOOK", 4)
    monkeypatch.setattr(op13, "TEXT", 20)
    monkeypatch.setattr(op13, "MEMO", 5)
    enc, rng = op13.ByteEncoder(ranks), random.Random(3)
    alphabet = ["a b", " \t\r\n\x1c\x85\xa0　", "éüß", "漢字", "😀‍", "12٣", "'sre", "<|", "etaoinshr", "\U00032000\U00010945"]
    for _ in range(3_000):
        text = "".join(rng.choice(rng.choice(alphabet)) for _ in range(rng.randint(0, 60)))
        assert enc.encode(text) == packed(library.encode_ordinary(text)), text


def test_op13_pair_rule_equals_the_merges(ranks):
    t, rng = op13.Transducer(ranks), random.Random(4)
    common = [k for k in t.token if k < 3_000]
    for _ in range(20_000):
        a, b = rng.choice(common), rng.choice(common)
        x, y = t.token[a], t.token[b]
        assert t._may_follow(a, b) == (t.merge(x + y) == [x, y])


def test_op13_ids_leave_before_the_unit_ends(ranks):
    t = op13.Transducer(ranks)
    ended, state = [], 0
    for byte in b"abcdefghij" * 40:
        hit = t._next.get(state << 8 | byte) or t._step(state, byte)
        state = hit >> 20
        ended.append(hit & 0xFFFFF)
    assert len(ended) - t._agreed(state, ended) <= 2 * max(map(len, ranks))


def test_op13_streaming_decode_of_cut_and_broken_characters(ranks, monkeypatch):
    tokens, rng = op13.TokenBytes(ranks), random.Random(5)
    token = {v: k for k, v in ranks.items()}
    for _ in range(3_000):
        ids = [rng.choice([rng.randrange(len(token)), rng.randrange(256)]) for _ in range(rng.randint(0, 12))]
        raw = b"".join(token[i] for i in ids)
        monkeypatch.setattr(op13, "BLOCK", rng.choice([1, 2, 100]))
        parts = list(op13.blocks(tokens, packed(ids)))
        assert b"".join(parts) == raw
        assert op13.decode_text(parts) == raw.decode("utf-8", "replace")
    whole = "漢字😀é".encode()
    stream = op13.StreamDecoder(tokens)
    parts = [stream.feed(np.array([ranks[bytes([b])]])) for b in whole]
    assert all(p.decode() == p.decode("utf-8", "replace") for p in parts) and b"".join(parts) == whole
    with pytest.raises(ValueError):
        op13.TokenBytes({b"a": 0, b"b": 2}).raw(np.array([1]))


# --- 12: alignment --------------------------------------------------------------


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_files.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_files.path("piece_bpe_32k.model"))
    letters = {v: k for k, v in enumerate(_letters())}

    def a_bytes(k):
        return bytes(letters[c] for c in a.id_to_token(k))

    def b_bytes(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        p, q = [a_bytes(k) for k in x], [b_bytes(k) for k in y]
        return (x, p, y, q) if b"".join(p) == b"".join(q) == (" " + text).encode() else None

    return both


def _letters():
    """Letters of the 256 bytes, from the rule of byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def brute(texts, both):
    """Rows of the contract, by plain loops."""
    aligned, holders = [], collections.Counter()
    for text in texts:
        found, groups = both(text), []
        if found:
            x, p, y, q = found
            ends_a, ends_b = np.cumsum([len(t) for t in p]).tolist(), np.cumsum([len(t) for t in q]).tolist()
            i = j = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                i2, j2 = ends_a.index(end) + 1, ends_b.index(end) + 1
                groups.append((x[i:i2], y[j:j2]))
                i, j = i2, j2
        links = collections.Counter((s, t) for g, h in groups for s in g for t in h)
        holders.update(links.keys())
        aligned.append((found, groups, links))
    best = collections.Counter()
    for (s, _), n in holders.items():
        best[s] = max(best[s], n)
    for found, groups, links in aligned:
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        yield (len(found[0]) if found else 0, len(found[2]) if found else 0, len(groups), sum(links.values()),
               sum(n for (s, t), n in links.items() if holders[s, t] == best[s]), sum(n * holders[x] for x, n in links.items()),
               hashlib.sha256(said.encode()).hexdigest() if groups else "")


def files(spark):
    return file_bytes(spark, tokenizer_files.path("byte_bpe_50k.json")), file_bytes(spark, tokenizer_files.path("piece_bpe_32k.model"))


def test_op12_figures_equal_brute_force(spark, docs, data, sides, monkeypatch):
    a, b = files(spark)
    some = docs.where("text is null or length(text) < 5000")
    want = collections.Counter(zip([r[0] for r in data if len(r[1] or "") < 5000], brute([r[1] for r in data if len(r[1] or "") < 5000], sides), strict=True))
    for parts in (1, 5):
        blocks = stored(op12.aligned_blocks(some.repartition(parts), a, b), "test-aligned")
        got = op12.figures(blocks, op12.pair_counts(blocks)).collect()
        assert collections.Counter((r[0], tuple(r[1:])) for r in got) == want
    empty = stored(op12.aligned_blocks(docs.limit(0), a, b), "test-aligned")
    assert op12.figures(empty, op12.pair_counts(empty)).collect() == []


def test_op12_groups_cover_both_sides(spark, docs, data, sides):
    a, b = files(spark)
    for r in op12.groups(docs.where("doc_id >= 1000"), a, b).collect():
        found = sides(ODD[r.doc_id - 1_000])
        if found is None:
            assert r.a_ids == r.b_ids == r.ends == []
            continue
        x, p, y, q = found
        assert (r.a_ids, r.b_ids) == (x, y)
        assert r.ends == sorted(set(np.cumsum([len(t) for t in p]).tolist()) & set(np.cumsum([len(t) for t in q]).tolist()))
        assert [len(b"".join(p[:k])) for k in r.a_to] == r.ends == [len(b"".join(q[:k])) for k in r.b_to]


def test_op12_gallop_equals_a_plain_search():
    rng = np.random.default_rng(6)
    for _ in range(300):
        among = np.unique(rng.integers(0, 2_000, rng.integers(1, 400)))
        values = np.unique(rng.integers(0, among[-1] + 1, rng.integers(1, 400)))
        assert (op12.gallop(values, among) == np.searchsorted(among, values)).all()
        i, j = op12.common_ends(values, among)
        assert values[i].tolist() == among[j].tolist() == sorted(set(values.tolist()) & set(among.tolist()))


def test_op12_wide_groups_and_blocks_change_nothing(spark, docs, data, sides, monkeypatch):
    with open(tokenizer_files.path("byte_bpe_50k.json"), "rb") as fa, open(tokenizer_files.path("piece_bpe_32k.model"), "rb") as fb:
        pair = op12.Pair(fa.read(), fb.read())
    texts = [r[1] for r in data][:40] + ODD
    plain = op12.Alignment(pair, texts).links()
    monkeypatch.setattr(op12, "WIDE", 1)
    assert all((x == y).all() for x, y in zip(plain, op12.Alignment(pair, texts).links(), strict=True))


# --- 11: hard negatives ----------------------------------------------------------


def brute_negatives(table, low=80, high=100, anchors=lambda i: i % 100 == 0):
    """(anchor, positive, rank, negative, scores) by scoring everything; vectors padded with zeros."""
    width = max((len(v) for _, _, v in table), default=0)
    ids, labels = np.array([r[0] for r in table]), np.array([r[1] for r in table])
    x = np.array([list(r[2]) + [0] * (width - len(r[2])) for r in table], np.int64).reshape(len(table), width)
    out = []
    for anchor in sorted({i for i in ids.tolist() if anchors(i)}):
        label, v = min((r[1], list(r[2])) for r in table if r[0] == anchor)
        score = x @ np.array(v + [0] * (width - len(v)), np.int64)
        order = np.lexsort((ids, -score))
        same = [k for k in order if labels[k] == label and ids[k] != anchor][:5]
        for p in same:
            hits = [k for k in order if labels[k] != label and low * score[p] <= 100 * score[k] <= high * score[p]][:5]
            out += [(anchor, ids[p], rank, ids[k], score[p], score[k]) for rank, k in enumerate(hits, 1)]
    return collections.Counter(tuple(map(int, r)) for r in out)


def vectors(n, dim, seed, hot=0.0):
    rng = np.random.default_rng(seed)
    x = rng.integers(-20, 21, (n, dim))
    x[rng.random(n) < hot] = x[0]
    return [(k, int(label), row.tolist()) for k, (label, row) in enumerate(zip(rng.integers(0, 4, n), x, strict=True))]


@pytest.mark.parametrize(("n", "dim", "hot"), [(700, 6, 0.0), (900, 3, 0.4), (5, 2, 0.0)])
def test_op11_equals_brute_force(spark, n, dim, hot, monkeypatch):
    ship_package(spark)
    table = vectors(n, dim, n, hot)
    table += [table[0], (100, 9, [1] * dim), (7_000, 1, []), (7_001, 2, [3]), (7_100, 3, [5] * (dim + 2))]
    monkeypatch.setattr(op11, "BLOCK", 3)
    df = spark.createDataFrame(table, op11._ROWS)
    df = stored(df, "test-vectors")
    for size in (64, 1_000):
        monkeypatch.setattr(op11.shards, "__defaults__", (size,))
        got = op11.hard_negatives(df, df.where("vec_id % 100 = 0")).collect()
        assert collections.Counter(tuple(r) for r in got) == brute_negatives(table)


def test_op11_rows_without_part_and_empty_table(spark):
    ship_package(spark)
    nan, inf = float("nan"), float("inf")
    data = [(0, 1, [0.5, -0.5]), (1, 1, [0.25, 0.1]), (2, 2, [0.2, 0.1]), (None, 2, [0.2, 0.1]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [None, 1.0]),
            (6, 2, [nan, 1.0]), (7, 2, [inf, 0.0]), (8, 1, []), (100, 3, [-0.001, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").selectExpr("*", "'clash' as shard", "1 as rank")
    got = {tuple(r) if r.vector is None else (r.vec_id, r.label, tuple(r.vector)) for r in op11.scaled(df).collect()}
    assert got == {(0, 1, (128, -128)), (1, 1, (64, 25)), (2, 2, (51, 25)), (8, 1, ()), (100, 3, (-1, 0))}
    rows_ = stored(op11.scaled(df), "test-vectors")
    assert collections.Counter(tuple(r) for r in op11.hard_negatives(rows_, rows_.where("vec_id % 100 = 0")).collect()) == \
        brute_negatives([(0, 1, [128, -128]), (1, 1, [64, 25]), (2, 2, [51, 25]), (8, 1, []), (100, 3, [-1, 0])])
    none = stored(op11.scaled(df.limit(0)), "test-vectors")
    assert op11.hard_negatives(none, none).collect() == []


def test_op11_sends_neither_shards_nor_blocks_through_the_driver(spark, monkeypatch):
    ship_package(spark)
    table = vectors(600, 4, 2, 0.5)
    df = stored(spark.createDataFrame(table, op11._ROWS), "test-vectors")
    monkeypatch.setattr(op11.shards, "__defaults__", (64,))
    found = op11.hard_negatives(df, df.where("vec_id % 100 = 0"))
    planned = found._jdf.queryExecution().executedPlan().toString()
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_negatives(table)
    assert "Broadcast" not in planned + found._jdf.queryExecution().executedPlan().toString()


def test_op11_windows_in_any_order_give_the_first_rows():
    rng = np.random.default_rng(9)
    x = rng.integers(-9, 10, (1_500, 5))
    x[rng.random(1_500) < 0.4] = x[0]
    labels = rng.integers(0, 3, 1_500)
    tree = op11.Tree(np.arange(1_500), labels, x)
    for anchors in (x[:8], x[:8] << 50):  # scores as doubles, then as whole numbers; rows are kept for the next block
        q, rows_, least, most = tree.ask(anchors)
        for k in range(8):
            asked = op11.Asked(tree, q[k], rows_, least[k], most[k], k, int(labels[k]), same=False)
            score = x @ anchors[k]
            for top in rng.permutation(score)[:12].tolist() + [int(score.max())]:
                floor = top - abs(top) // 5
                want = [i for i in np.lexsort((np.arange(1_500), -score)) if labels[i] != labels[k] and floor <= score[i] <= top][:5]
                assert asked.first(5, floor, top) == [(score[i], i) for i in want]


def test_op11_query_equals_brute_force(spark):
    ship_package(spark)
    table = []
    for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect():
        v = np.floor(256 * np.array(r.embedding, np.float64)).astype(np.int64).tolist()
        table.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, v))
    got = catalog.queries()["op11_hard_negatives"](spark, SF_SMALL).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_negatives(table)


def test_op11_boxes_bound_their_rows_and_searches_skip_boxes():
    rng = np.random.default_rng(8)
    centre = rng.integers(-200, 200, (12, 8))
    x = centre[rng.integers(0, 12, 4_000)] + rng.integers(-5, 6, (4_000, 8))
    tree = op11.Tree(np.arange(4_000), rng.integers(0, 3, 4_000), x)
    for node in range(tree.leaves):
        part = tree.vectors[tree.start[node] : tree.start[node + 1]]
        assert (part.min(0) == tree.low[node]).all() and (part.max(0) == tree.high[node]).all() and len(part) <= op11.LEAF
    assert sorted(tree.ids.tolist()) == list(range(4_000))
    q, rows_, least, most = tree.ask(x[:50])
    opened = []
    for k in range(50):
        asked = op11.Asked(tree, q[k], rows_, least[k], most[k], k, 0, same=True)
        asked.first(5)
        opened.append(len(asked._scored))
    assert sum(opened) < 0.5 * 50 * tree.leaves
