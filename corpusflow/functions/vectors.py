"""F9 L2 normalisation and F10 int8 scalar quantisation, as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(v: Column | str) -> Column:
    """Unit-length ``array<float>``; a zero vector stays zero, NULL stays NULL."""
    vec = _c(v)
    n = l2_norm(vec)
    return F.when(n == 0, vec).otherwise(F.transform(vec, lambda x: (x.cast("double") / n).cast("float")))


#: Size of the quantile sketches, and how often the values inside the brackets are sketched again.
SKETCH_K, ROUNDS = 4_096, 2
#: Cells of the grid of quantiles that brackets are taken from.
GRID = 512


def sketch_error(k: int = SKETCH_K) -> float:
    """Rank error of a KLL sketch as a share of its values: the published fit of the 99 % bound,
    2.296 / k ** 0.9723 (fixed values), four times over, which is beyond ten standard deviations."""
    return 4 * 2.296 / k**0.9723


def exact_quantiles(values: DataFrame, col: str, by: tuple[str, ...], qs: tuple[float, ...], k: int = SKETCH_K, rounds: int = ROUNDS) -> DataFrame:
    """Exact order statistics per group: for each q the value of rank ``max(ceil(q*n), 1)``.

    One plan, nothing eager, memory independent of the group's size. A mergeable sketch (KLL) per
    group gives two values that bracket each rank. Each further round counts the values below
    every bracket and sketches those inside it, which narrows the bracket by the sketch's
    error again; brackets stay a table (one row per group and quantile) that joins the values.
    At last the values inside a bracket are counted by value and a running sum finds the rank:
    for n values at most about ``n * (2 * sketch_error(k) + 2 / GRID) ** rounds`` distinct ones. A bracket
    that missed its rank raises instead of giving a wrong value.
    """
    x = values.select(*by, F.col(col).cast("double").alias("_x")).where("_x is not null")
    exact = [F.lit(f"{q:.12f}").cast("decimal(20,12)") for q in qs]
    first = x.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("_sketch"))
    ranks = F.array(*[F.struct(F.lit(i).alias("_qi"), F.greatest(F.ceil(F.col("_n") * q), F.lit(1)).cast("long").alias("_k")) for i, q in enumerate(exact)])
    targets = first.select(*by, "_n", "_sketch", F.explode(ranks).alias("_t")).select(*by, "_t.*", F.col("_k").alias("_need"), "_n", "_sketch")
    brackets = _bracket(targets, by, k)
    for _ in range(rounds - 1):
        brackets = _narrowed(x, by, brackets, k)
    return _select_ranks(x, by, brackets)


def _bracket(targets: DataFrame, by: tuple[str, ...], k: int) -> DataFrame:
    """Values around the rank ``_need`` of the ``_n`` values that a sketch holds: cells of a grid of
    its quantiles (Spark asks for constant ranks)."""
    grid = F.kll_sketch_get_quantile_double("_sketch", F.lit([i / GRID for i in range(GRID + 1)]))
    margin = F.lit(sketch_error(k)) * F.col("_n") + 1
    cell = lambda rank: F.greatest(F.least(rank / F.col("_n") * GRID, F.lit(float(GRID))), F.lit(0.0))
    low, high = F.floor(cell(F.col("_need") - margin)).cast("int"), F.ceil(cell(F.col("_need") + margin)).cast("int")
    return targets.withColumn("_grid", grid).select(*by, "_qi", "_k", F.get("_grid", low).alias("_lo"), F.get("_grid", high).alias("_hi"))


def _narrowed(x: DataFrame, by: tuple[str, ...], brackets: DataFrame, k: int) -> DataFrame:
    """The brackets, narrowed by a sketch of the values inside them."""
    inside = F.col("_x") >= F.col("_lo")
    found = x.join(brackets, list(by)).where(F.col("_x") <= F.col("_hi")).groupBy(*by, "_qi", "_k").agg(
        F.count_if(~inside).alias("_below"), F.count_if(inside).alias("_n"), F.kll_sketch_agg_double(F.when(inside, F.col("_x")), F.lit(k)).alias("_sketch"))
    return _bracket(found.withColumn("_need", F.col("_k") - F.col("_below")), by, k)


def _select_ranks(x: DataFrame, by: tuple[str, ...], brackets: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    j = x.join(brackets, list(by)).where(F.col("_x") <= F.col("_hi"))
    # everything under the bracket collapses into one -inf key: one pass gives both
    # the count below and the (value, count) rows inside
    key = F.when(F.col("_x") < F.col("_lo"), F.lit(float("-inf"))).otherwise(F.col("_x"))
    counts = j.groupBy(*by, "_qi", "_k", key.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by, "_qi").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_cum", F.sum("_c").over(w))
    hit = ranked.groupBy(*by, "_qi").agg(F.min(F.when(F.col("_cum") >= F.col("_k"), F.col("_v"))).alias("_val"))
    # the sketch's bound says the rank lies inside the bracket; fail loudly rather than be wrong
    bad = F.col("_val").isNull() | (F.col("_val") == float("-inf"))
    return hit.select(
        *by, "_qi", F.when(bad, F.raise_error(F.lit("exact_quantiles: rank outside the sketch bracket"))).otherwise(F.col("_val")).alias("value")
    )


def quantile_bounds(
    points: DataFrame,
    vector_col: str = "vector",
    by: tuple[str, ...] = ("collection",),
    quantile: float = 0.99,
    k: int = SKETCH_K,
    exact: bool = True,
) -> DataFrame:
    """Per group, the (1-q)/2 and (1+q)/2 quantiles of all vector components.

    ``exact=True`` (default) returns the exact order statistics via
    ``exact_quantiles``; ``exact=False`` keeps only the sketch (one pass, rank
    error ``sketch_error(k)`` of the values). Neither gathers a group's values in one task.
    """
    lo_q, hi_q = round((1.0 - quantile) / 2.0, 12), round((1.0 + quantile) / 2.0, 12)
    comp = points.select(*by, F.explode(vector_col).alias("_x")).withColumn("_x", F.col("_x").cast("double"))
    if not exact:
        sketch = comp.groupBy(*by).agg(F.kll_sketch_agg_double("_x", F.lit(k)).alias("_s"))
        return sketch.select(*by, *[F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(n) for n, q in (("q_lo", lo_q), ("q_hi", hi_q))])
    ex = exact_quantiles(comp, "_x", by, (lo_q, hi_q), k)
    return ex.groupBy(*by).agg(
        F.max(F.when(F.col("_qi") == 0, F.col("value"))).alias("q_lo"),
        F.max(F.when(F.col("_qi") == 1, F.col("value"))).alias("q_hi"),
    )


def quantize_col(v: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """int8 codes: clamp to [lo, hi], scale to 0..255, shift to -128..127."""
    lo_c, hi_c = _c(lo), _c(hi)
    span = hi_c - lo_c

    def code(x: Column) -> Column:
        xc = F.least(F.greatest(x.cast("double"), lo_c), hi_c)
        scaled = F.when(span > 0, (xc - lo_c) / span * 255.0).otherwise(F.lit(0.0))
        return (F.round(scaled, 0) - 128).cast("tinyint")

    return F.transform(_c(v), code)


def quantize_int8(
    points: DataFrame,
    vector_col: str = "vector",
    by: tuple[str, ...] = ("collection",),
    quantile: float = 0.99,
    k: int = SKETCH_K,
    exact: bool = True,
) -> DataFrame:
    """Adds ``q_lo``, ``q_hi`` and ``codes`` (array<tinyint>) to every point.

    The bounds are part of the same plan: one row per collection, joined by
    whatever way Spark's measured sizes allow.
    """
    bounds = quantile_bounds(points, vector_col, by, quantile, k, exact)
    return points.join(bounds, list(by)).withColumn("codes", quantize_col(vector_col, "q_lo", "q_hi"))
