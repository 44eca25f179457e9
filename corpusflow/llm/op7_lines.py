"""Line dedup by a segment-partition edit join, on DataFrame functions only.

A line goes if an equal line, or one within ``TAU`` edits, comes earlier (smaller
doc_id, then line number; judged on the input). Distinct lines of ``MIN_NEAR``
code points or more are cut into TAU + 1 segments: of two lines within TAU edits
one must hold a segment of the shorter at a place that the length difference
bounds, so an index on (length, segment number, segment) is probed with those
few substrings; parities of the lines' character counts prune pairs in the join.
Of lines that share a key with many others only those are paired that agree in
more: what is left of the line is narrowed by halves and thirds, round by round,
to the one or two places of the edits. Candidates are verified by banded bit-parallel edit
distance over the part between common ends.

Defined cases: null and empty texts have no lines; blank lines are kept and never
compared; shorter lines go only as exact copies; rows that repeat a doc_id count
as one document (equal lines at an equal place stay in each); an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, broadcast_checked, stored, table

TAU = 2
MIN_NEAR = 16
#: Lines that may share an index key before the key is split further.
HOT = 16
#: Lines that may agree in all but one or two places before these are narrowed further.
FEW = 40
SPACES = " \t\n\x0b\f\r"


def _segment(length: Column, j: Column, tau: int) -> tuple[Column, Column]:
    """Offset and width of segment ``j``; the last segments take the remainder."""
    width, rest = F.floor(length / (tau + 1)).cast("int"), length % (tau + 1)
    longer = F.greatest(F.lit(0), j - (F.lit(tau + 1) - rest))
    return width * j + longer, width + (j >= F.lit(tau + 1) - rest).cast("int")


def _key(base: Column, length: Column, j: Column, part: Column) -> Column:
    return F.xxhash64(base, length, j, part)


def _cut(text: Column, at: Column, width: Column) -> Column:
    return F.substring(text, at + 1, width)


def _each(lines: DataFrame, names: str, spots: list[tuple[int, ...]]) -> DataFrame:
    """A row of ``lines`` for each of the spots, whose numbers become columns: a
    generator over a constant keeps the generated code of the keys short."""
    return lines.select("*", F.inline(F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in zip(names.split(), spot)]) for spot in spots])))


def index_rows(lines: DataFrame, tau: int) -> DataFrame:
    """(key, lid): keys of a line's own segments."""
    rows = _each(lines, "j", [(j,) for j in range(tau + 1)])
    return rows.select(_key(F.lit(0).cast("long"), F.col("n"), F.col("j"), _cut(F.col("line"), *_segment(F.col("n"), F.col("j"), tau))).alias("key"), "lid")


def probe_rows(lines: DataFrame, tau: int) -> DataFrame:
    """(key, other): keys under which a line finds lines of its length or up to ``tau`` shorter."""
    spots = [(less, j, shift) for less in range(tau + 1) for j in range(tau + 1) for shift in range(max(-j, less - (tau - j)), min(j, less + (tau - j)) + 1)]
    short = F.col("n") - F.col("less")
    rows = _each(lines, "less j shift", spots).where((short > tau) & _fits(short, tau))
    at, width = _segment(short, F.col("j"), tau)
    return rows.select(_key(F.lit(0).cast("long"), short, F.col("j"), _cut(F.col("line"), at + F.col("shift"), width)).alias("key"), F.col("lid").alias("other"))


def _fits(short: Column, tau: int) -> Column:
    at, width = _segment(short, F.col("j"), tau)
    return (at + F.col("shift") >= 0) & (at + F.col("shift") + width <= F.col("n"))


def _parity() -> Column:
    """64 bits: which of 64 classes of characters occur an odd number of times."""
    return F.expr("aggregate(split(line, ''), 0L, (bits, c) -> bits ^ shiftleft(1L, hash(c)))")


def _may_match(tau: int) -> Column:
    """An edit takes at most one character and adds at most one, so lines within
    ``tau`` edits differ in at most 2 tau parities."""
    return F.bit_count(F.col("parity").bitwiseXOR(F.col("other_parity"))) <= 2 * tau


def candidates(lines: DataFrame, tau: int) -> DataFrame:
    """Pairs (a, b), a < b, of lines (lid, line, n) that share a key of at most
    ``HOT`` lines, or agree in all but one or two places with at most ``FEW``."""
    index, probe = index_rows(lines, tau), probe_rows(lines, tau)
    hot = stored(index.groupBy("key").agg(F.count("*").alias("lines")).where(F.col("lines") > HOT).select("key"), "hot_keys")
    n_hot = hot.count()
    near = F.broadcast(hot) if n_hot <= 100_000 else hot
    # a hot key meets its probes in one row without a line
    cool = index.join(near, "key", "left_anti").union(hot.select("key", F.lit(None).cast("long"))) if n_hot else index
    met = stored(probe.join(cool, "key").where(F.col("lid").isNull() | (F.col("lid") != F.col("other"))), "line_met")
    pairs = _ordered(met.where("lid is not null"))
    if n_hot:
        # a line of a hot key also meets that key as a probe
        own = index.join(near, "key").select("lid", F.lit(1).alias("own"))
        hot_lines = met.where("lid is null").select(F.col("other").alias("lid"), F.lit(0).alias("own")).union(own).groupBy("lid").agg(F.max("own").alias("own"))
        hot_lines = lines.join(broadcast_checked(stored(hot_lines, "hot_lines")), "lid").withColumn("parity", _parity())
        # the shorter line's length is known from the first key on
        starts = _each(stored(hot_lines, "hot_texts"), "less", [(k,) for k in range(tau + 1)])
        short = F.col("n") - F.col("less")
        starts = starts.where(short > tau).select("lid", "parity", F.when(F.col("less") == 0, F.col("own")).otherwise(0).alias("own"), F.lit(2 if tau == 2 else 1).alias("kind"), F.lit(0).cast("long").alias("base"), F.col("line").alias("l"), F.lit("").alias("r"), short.alias("nl"), F.lit(0).alias("nr"))
        pairs = pairs.union(_split_pairs(_narrowed(starts, tau).join(near.withColumnRenamed("key", "gate"), "gate", "left_semi"), tau))
    return pairs.distinct()


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.least("lid", "other").alias("a"), F.greatest("lid", "other").alias("b"))


def _split_pairs(states: DataFrame, tau: int) -> DataFrame:
    """Pairs of states of equal base, narrowed until few lines share a base.

    A state is a line of which all but one or two places (l, r; of nl and nr
    characters in the shorter line) is in the base; own: 1 if it can be the shorter
    line (or the other of a line as long), 0 if only the other. Its kind says where the edits are: 2 or 1 of them at most in l,
    or (11) exactly one in l and one in r. Every pair within ``tau`` edits follows
    one way of narrowing; the places get shorter in each round. What lies in the
    base is the same in both lines, so parities of whole lines tell of the places.
    """
    found = None
    while True:
        states = stored(states.drop("gate"), "line_states")
        l, r = F.xxhash64("l"), F.xxhash64("r")
        bases = states.groupBy("base").agg(F.sum("own").alias("lines"), F.min("lid").alias("low"), F.max("lid").alias("high"), F.max(_done()).alias("done"),
                                           ((F.max("kind") == 11) & ((F.min(l) == F.max(l)) | (F.min(r) == F.max(r)))).alias("same"))
        # no pair: no shorter line or one line only, or one of the two places the same in all
        bases = stored(bases.where("lines > 0 and low < high and not same").select("base", ((F.col("lines") <= FEW) | F.col("done")).alias("ready")), "line_bases")
        n_ready, n_large = bases.agg(F.count_if("ready"), F.count_if(~F.col("ready"))).first()
        ready, large = bases.where("ready").select("base"), bases.where("not ready").select("base")
        left = states.where("own = 1").join(F.broadcast(ready) if n_ready <= BROADCAST_ROWS else ready, "base", "left_semi")
        other = states.select("base", F.col("lid").alias("other"), F.col("parity").alias("other_parity"), F.col("l").alias("other_l"), F.col("r").alias("other_r"))
        longer = F.char_length("other_l") + F.char_length("other_r") > F.col("nl") + F.col("nr")
        differ = (longer | (F.col("lid") < F.col("other"))) & (F.col("l") != F.col("other_l")) & ((F.col("kind") != 11) | (F.col("r") != F.col("other_r")))
        pairs = stored(_ordered(left.join(other, "base").where(differ & _may_match(tau))), "line_split")
        found = pairs if found is None else found.union(pairs)
        if not n_large:
            return found
        states = _narrowed(states.join(F.broadcast(large) if n_large <= BROADCAST_ROWS else large, "base", "left_semi"), tau)


def _done() -> Column:
    """The places are too short to be split."""
    return F.when(F.col("kind") == 2, F.col("nl") <= 2).otherwise((F.col("nl") <= 1) & (F.col("nr") <= 1))


def _narrowed(states: DataFrame, tau: int) -> DataFrame:
    """The states that follow, each with one more part in its base; gate is the
    key of ``index_rows`` and ``probe_rows`` for the first part."""
    found = _halved(states.where("kind <> 2"))
    return found.union(_thirds(states.where("kind = 2"))) if tau == 2 else found


def _halved(states: DataFrame) -> DataFrame:
    """One edit in a place: its first or its second half is the same in both lines."""
    rows = _each(states, "i k", [(0, 0), (0, 1), (1, 0), (1, 1)]).where("(i = 0 or nl > 1) and (k = 0 or nr > 1)")
    for text, n, half in (("l", "nl", "i"), ("r", "nr", "k")):
        x, m, first = F.col(text), F.col(n), F.col(half) == 0
        width = F.when(first, F.when(m > 1, F.floor(m / 2)).otherwise(0)).otherwise(m - F.floor(m / 2)).cast("int")
        rows = rows.withColumn(f"{text}w", width).withColumn(f"{text}m", F.char_length(x)).where(f"{text}m >= {text}w")
        left = F.col(f"{text}m") - F.col(f"{text}w")
        rows = rows.withColumns({f"{text}_same": F.when(first, _cut(x, F.lit(0), F.col(f"{text}w"))).otherwise(_cut(x, left, F.col(f"{text}w"))),
                                 f"{text}_left": F.when(first, _cut(x, F.col(f"{text}w"), left)).otherwise(_cut(x, F.lit(0), left))})
    gate = _key(F.col("base"), F.col("nl"), F.col("i"), F.col("l_same"))
    base = F.when(F.col("kind") == 1, gate).otherwise(F.xxhash64(gate, F.col("nr"), F.col("k"), F.col("r_same")))
    return rows.select("lid", "parity", "own", "kind", base.alias("base"), F.col("l_left").alias("l"), F.col("r_left").alias("r"), (F.col("nl") - F.col("lw")).alias("nl"), (F.col("nr") - F.col("rw")).alias("nr"), gate.alias("gate"))


def _thirds(states: DataFrame) -> DataFrame:
    """Up to two edits in a place of three parts, by the part of the first edit:
    (0) not in the first part; (1) in the first, and one in the third; (2) all in
    the first; (3) in the first, and one in the second. Shift: by how much the first
    edit makes the other line longer; the shorter line is cut where its own parts end."""
    spots = [(0, 0), *((1, s) for s in (-1, 0, 1)), (2, 0), *((3, s) for s in (-1, 0, 1))]
    rows = _each(states, "way shift", spots).withColumns({"m": F.char_length("l"), **{f"w{j}": _segment(F.col("nl"), F.lit(j), 2)[1] for j in range(3)}})
    rows = rows.where("way in (0, 2) or shift >= m - nl - 1")
    x, m, way = F.col("l"), F.col("m"), F.col("way")
    w0, w1, w2, cut = F.col("w0"), F.col("w1"), F.col("w2"), F.col("w0") + F.col("shift")
    rows = rows.where((cut >= 0) & F.when(way == 0, w0 <= m).when(way == 1, cut + w1 <= m).when(way == 2, w1 + w2 <= m).otherwise(cut + w2 <= m))
    rows = rows.withColumn("same", F.when(way == 0, _cut(x, F.lit(0), w0)).when(way == 1, _cut(x, cut, w1)).otherwise(_cut(x, m - w2, w2)))
    gate = _key(F.col("base"), F.col("nl"), F.least(way, F.lit(2)), F.col("same"))
    base = F.when(way <= 1, gate).when(way == 2, F.xxhash64(gate, way, _cut(x, m - w2 - w1, w1))).otherwise(F.xxhash64(gate, way))
    left = F.when(way == 0, _cut(x, w0, m)).when(way == 2, _cut(x, F.lit(0), m - w2 - w1)).otherwise(_cut(x, F.lit(0), cut))
    right = F.when(way == 1, _cut(x, cut + w1, m)).when(way == 3, _cut(x, cut, m - w2 - cut)).otherwise("")
    nr = F.when(way == 1, w2).when(way == 3, w1).otherwise(0)
    kind = F.when(way.isin(0, 2), 2).otherwise(11)
    own = F.when(F.col("shift") == 0, F.col("own")).otherwise(0)
    return rows.select("lid", "parity", own.alias("own"), kind.alias("kind"), base.alias("base"), left.alias("l"), right.alias("r"), F.when(way == 0, w1 + w2).otherwise(w0).alias("nl"), nr.alias("nr"), gate.alias("gate"))


def _common(most: str, x: str, y: str) -> Column:
    """Length of a common start or end by halving steps: ``x`` and ``y`` cut what
    step s adds to the length p."""
    steps = ", ".join(str(1 << k) for k in range(16, -1, -1))
    return F.expr(f"aggregate(array({steps}), 0, (p, s) -> if(p + s <= {most} and {x} = {y}, p + s, p))")


def within(pairs: DataFrame, tau: int) -> DataFrame:
    """Pairs with columns x and y whose edit distance is at most ``tau``."""
    ends = pairs.withColumns({"lx": F.char_length("x"), "ly": F.char_length("y")})
    ends = ends.withColumn("head", _common("least(lx, ly)", "substring(x, p + 1, s)", "substring(y, p + 1, s)"))
    ends = ends.withColumn("tail", _common("least(lx, ly) - head", "substring(x, lx - p - s + 1, s)", "substring(y, ly - p - s + 1, s)"))
    cores = ends.selectExpr("*", "split(substring(x, head + 1, lx - head - tail), '') as cx", "split(substring(y, head + 1, ly - head - tail), '') as cy",
                            "lx - head - tail as la", "ly - head - tail as lb")
    dist = F.expr(f"if(least(la, lb) = 0, greatest(la, lb), if(abs(la - lb) > {tau}, {tau + 1}, {_banded(tau)}))")
    # a generator keeps the filter from being pushed down, which would inline the cores into every step
    measured = cores.select(*pairs.columns, F.explode(F.array(dist)).alias("dist"))
    return measured.where(F.col("dist") <= tau).select(*pairs.columns)


def _banded(tau: int) -> str:
    """Edit distance of cx (la characters) and cy (lb), exact up to ``tau``.

    Bit d of a vector is row j - tau + d of column j; vp and vn hold the vertical
    +1 and -1 steps. The score follows the lowest diagonal of the band until it
    reaches the last row, then that row.
    """
    band = (1 << (2 * tau + 1)) - 1
    match = " | ".join(f"if(coalesce(get(cx, j - {tau - d + 1}) = get(cy, j - 1), false), {1 << d}L, 0L)" for d in range(2 * tau + 1))
    last = f"la - j + {tau}"
    step = f"""if(j <= la - {tau}, 1L - (shiftrightunsigned(d0, {2 * tau}) & 1L),
        (shiftrightunsigned(h.hp, {last}) & 1L) - (shiftrightunsigned(h.hn, {last}) & 1L))"""
    return f"""cast(aggregate(sequence(1, lb),
      named_struct('vp', {band & ~((1 << tau) - 1)}L, 'vn', 0L, 'dist', cast(least(la, {tau}) as bigint)),
      (s, j) -> if(s.dist > {tau} + lb - la + {tau}, s,
        get(transform(array({match}), pm ->
          get(transform(array(((((pm & s.vp) + s.vp) ^ s.vp) | pm | s.vn) & {band}L), d0 ->
            get(transform(array(named_struct('hp', (s.vn | ~(d0 | s.vp)) & {band}L, 'hn', d0 & s.vp)), h ->
              named_struct('vp', (h.hn | ~(shiftrightunsigned(d0, 1) | h.hp)) & {band}L,
                           'vn', shiftrightunsigned(d0, 1) & h.hp, 'dist', s.dist + {step})), 0)), 0)), 0)),
      s -> s.dist) as int)"""


def occurrences(docs: DataFrame) -> DataFrame:
    """doc, i, line and its 128-bit name (h1, h2) of every non-blank line."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.posexplode(F.split(text, "\n", -1)).alias("i", "line"))
    rows = rows.where(F.trim("line", F.lit(SPACES)) != "")
    return rows.select("doc", "i", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """Stored distinct lines: lid, line, n, h1, h2, first (doc, i)."""
    grouped = occurrences(docs).groupBy("h1", "h2").agg(F.min(F.struct("doc", "i")).alias("first"), F.first("line").alias("line"))
    return stored(grouped.select(F.monotonically_increasing_id().alias("lid"), "line", F.char_length("line").alias("n"), "h1", "h2", "first"), "lines")


def line_links(lines: DataFrame, tau: int = TAU) -> DataFrame:
    """Stored links (a, b) of distinct lines within ``tau`` edits."""
    near = lines.where(F.col("n") >= MIN_NEAR).select("lid", "line", "n")
    pairs = stored(candidates(near, tau), "line_pairs")
    ids = stored(pairs.select(F.col("a").alias("lid")).union(pairs.select("b")).distinct(), "line_ids")
    texts = stored(near.select("lid", "line").join(broadcast_checked(ids), "lid").withColumn("parity", _parity()), "line_texts")
    slots = 4 * lines.sparkSession.sparkContext.defaultParallelism  # verification is CPU work on few bytes
    even = texts.select("lid", "parity")
    pairs = stored(pairs.join(even.toDF("a", "parity"), "a").join(even.toDF("b", "other_parity"), "b").where(_may_match(tau)).select("a", "b"), "line_even")
    texts = texts.drop("parity")
    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").repartition(slots, "a", "b")
    return stored(within(both, tau).select("a", "b"), "line_links")


def line_verdicts(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """Per non-blank line of each document: doc, i, copy (an equal line is earlier),
    near (a similar line is earlier), links (lines within ``tau`` edits)."""
    lines = distinct_lines(docs)
    links = line_links(lines, tau)
    places = lines.select("lid", "first")
    both = links.union(links.select("b", "a")).join(broadcast_checked(links.select(F.col("b").alias("lid")).union(links.select("a")).distinct().join(places, "lid").toDF("b", "other")), "b")
    linked = both.groupBy("a").agg(F.count("*").alias("links"), F.min("other").alias("least")).withColumnRenamed("a", "lid")
    judged = lines.select("lid", "h1", "h2", "first").join(linked, "lid", "left")
    judged = judged.select("h1", "h2", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce(F.col("least") < F.col("first"), F.lit(False)).alias("near"))
    found = occurrences(docs).drop("line").join(judged, ["h1", "h2"])
    copy = ~(F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("i") == F.col("first.i")))
    return found.select("doc", "i", copy.alias("copy"), "near", "links")


def dedup_lines(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``; other columns stay."""
    gone = line_verdicts(docs, tau).where("copy or near").groupBy("doc").agg(F.collect_list("i").alias("_gone"))
    # the row travels as one struct, so that no name of it can clash with ours
    joined = docs.select(F.struct("*").alias("own")).join(gone, F.col("own.doc_id").cast("long").eqNullSafe(F.col("doc")), "left")
    split = joined.withColumn("lines", F.split("own.text", "\n", -1))
    left = "array_except(sequence(0, size(lines) - 1), _gone)"
    text = F.expr(f"if(_gone is null, own.text, array_join(transform({left}, i -> get(lines, i)), '\n'))")
    return split.select(*[text.alias(c) if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    flags = {"n_lines": F.lit(True), "n_copies": F.col("copy"), "n_near": ~F.col("copy") & F.col("near"), "n_kept": ~F.col("copy") & ~F.col("near")}
    sums = [F.sum(c.cast("long")).alias(k) for k, c in flags.items()]
    per_doc = line_verdicts(docs).groupBy("doc").agg(*sums, F.sum(F.when(~F.col("copy"), F.col("links")).otherwise(0)).alias("n_links"))
    names = [*flags, "n_links"]
    joined = docs.select(F.col("doc_id").cast("long")).join(per_doc, F.col("doc_id").eqNullSafe(F.col("doc")), "left")
    return joined.na.fill(0, names).select("doc_id", *names)
