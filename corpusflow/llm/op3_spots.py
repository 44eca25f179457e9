"""Document fingerprints by spot signatures, on DataFrame functions only.

Every common-word anchor of a text opens a chain: the next ``CHAIN`` content words
(other common words are passed over). The set of chain hashes is the fingerprint,
written as sorted 32-bit hex. ``likeness`` is the Jaccard similarity of two sets;
``similar_pairs`` compares sets only within neighbouring classes of set length,
through their rarest signatures, and prunes by length before it intersects.

Defined cases: null and empty texts have an empty set (two empty sets are alike,
1.0; an empty and a filled one are not, 0.0); a text with fewer than ``MIN_SPOTS``
anchors opens a chain at every word; one without words has one signature, of the
whole text; of rows that repeat a doc_id the least text is the next document of
others; a null doc_id comes after all others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, with_group_min

CHAIN, REACH, MIN_SPOTS = 3, 12, 4
THRESHOLD = 0.8
#: Ids per bucket when the order of all ids is derived.
ID_BUCKET = 1 << 16
#: Stands for a null doc_id.
NO_ID = -(1 << 63)
# Common words that open a chain, and more that chains pass over.
ANCHORS = "the is of and was a der die und das le la les et el los y".split()
PASSED = ANCHORS + ("an are as at be by for from in it on or that this to with von mit ein eine zu den dem "
                    "de des du un une en est dans que por con una del se").split()
_BREAK = r"[\x00-/:-@\[-`{-\x7F]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: ascending distinct 32-bit signatures of column ``text``."""
    w = f"_words_{out}"

    def chain(at: Column) -> Column:
        ahead = F.filter(F.slice(F.col(w), at + 2, F.lit(REACH)), lambda x: ~x.isin(PASSED))
        return F.slice(ahead, 1, CHAIN)

    spots = F.array_compact(F.transform(F.col(w), lambda x, i: F.when(x.isin(ANCHORS), F.hash(x, F.array_join(chain(i), " ")))))
    every = F.transform(F.col(w), lambda x, i: F.hash(F.array_join(F.slice(F.col(w), i + 1, F.lit(CHAIN)), " ")))
    whole = F.when(F.col(text) == "", F.array().cast("array<int>")).otherwise(F.array(F.hash(F.col(text))))
    with_words = df.withColumn(w, _words(F.col(text))).withColumn("_spots", spots)
    chosen = F.when(F.size("_spots") >= MIN_SPOTS, F.col("_spots")).when(F.size(w) > 0, every).otherwise(whole)
    return with_words.withColumn(out, F.sort_array(F.array_distinct(chosen))).drop(w, "_spots")


def fingerprint(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets (1 for two empty sets)."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def next_ids(ids: DataFrame) -> DataFrame:
    """(key, next) of distinct keys in falling order; the first follows the last.

    Order within buckets of ``ID_BUCKET`` ids, then over one row per bucket.
    """
    bucket = F.floor(F.col("key") / ID_BUCKET)
    dealt = ids.select("key").distinct().withColumn("bucket", bucket)
    ends = dealt.groupBy("bucket").agg(F.max("key").alias("top"))
    order = Window.orderBy("bucket")  # one row per bucket
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = ends.select("bucket", F.coalesce(F.lag("top").over(order), F.last("top").over(whole)).alias("below"))
    inside = dealt.withColumn("lower", F.lag("key").over(Window.partitionBy("bucket").orderBy("key")))
    return inside.join(below, "bucket").select("key", F.coalesce("lower", "below").alias("next"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, signature, edited text, and the next document's signature."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    signed = signatures(keyed, "text", "sig")
    sizes = keyed.groupBy("key").agg(F.max(F.floor(F.char_length("text") / 2)).cast("int").alias("need"))
    wants = next_ids(keyed).join(sizes, "key").select(F.col("key").alias("owner"), F.col("next").alias("key"), "need")
    # both joins read the same columns of ``signed``, so its exchange is made once
    given = signed.join(wants, "key").select("owner", F.struct(F.expr("substring(text, 1, need)").alias("head"), "sig").alias("_next"))
    one = given.groupBy("owner").agg(F.min("_next").alias("_next")) if _repeats(keyed) else given
    joined = signed.join(one.withColumnRenamed("owner", "key"), "key")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("_next.head"), F.lit(1), half))
    doc_id = F.when(F.col("key") != NO_ID, F.col("key"))
    return joined.select(doc_id.alias("doc_id"), n.cast("long").alias("n_chars"), "sig", edited.alias("edited"), F.col("_next.sig").alias("next_sig"))


def _repeats(keyed: DataFrame) -> bool:
    """Whether a key occurs in several rows."""
    return bool(keyed.groupBy("key").count().where("count > 1").limit(1).count())


def similar_pairs(signed: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): (doc_id, rep) of equal sets, and (a, b, likeness) of
    representatives from ``threshold`` on, for stored rows (doc_id, sig).

    Sets of length n and m can only reach the threshold if the lesser is at least
    ``threshold`` of the greater, so classes of the logarithm of length meet only
    their neighbours. Of a set, only its rarest signatures (as many as any partner
    must share one of) are looked up.
    """
    named = signed.where(F.size("sig") > 0).withColumn("_name", F.md5(fingerprint(F.col("sig"))))
    members = with_group_min(named.select("doc_id", "_name"), "_name", "doc_id", "rep").select("doc_id", "rep")
    reps = stored(named.join(members.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
                  .select(F.col("doc_id").alias("id"), "sig", F.size("sig").alias("n"),
                          F.floor(F.log(F.size("sig")) / F.log(F.lit(1 / threshold))).cast("int").alias("part")), "spot_sets")
    flat = reps.select("id", "n", "part", F.explode("sig").alias("s"))
    rare = flat.join(flat.groupBy("s").agg(F.count("*").alias("df")), "s")
    looked = F.size("sigs") - F.ceil(F.size("sigs") * threshold) + 1
    ranked = rare.groupBy("id", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("sigs"))
    prefix = stored(ranked.select("id", "n", "part", F.explode(F.slice("sigs", F.lit(1), looked.cast("int"))).alias("x")).select("id", "n", "part", "x.s"), "spot_prefixes")
    own = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "part", "s")
    near = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "s")
    pruned = (F.least("na", "nb") >= threshold * F.greatest("na", "nb")) & (F.col("a") != F.col("b"))
    met = own.join(near, ["part", "s"]).where(pruned).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sets = reps.select("id", "sig")
    both = met.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").withColumn("likeness", likeness(F.col("x"), F.col("y")))
    return members, both.where(F.col("likeness") >= threshold).select("a", "b", "likeness")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signatures(edited_pairs(table(spark, sf_dir, "documents")), "edited", "edited_sig")
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sig")).alias("fingerprint"),
                        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
                        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
