"""Fingerprints of documents: the smallest ``k`` hashes of their shingles, in plain columns.

A sketch is a sorted array of at most ``k`` distinct 64-bit hashes. The smallest ``k`` of two sketches' union
are the sketch of both documents together, so sketches of parts merge, and what two sketches share among
those estimates resemblance. All work is Spark expressions on the row; only merging and neighbours shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodewright.llm.tables import WORD, lower_ascii

WORDS = 5
K = 128
# Hashes are dealt evenly over this many values.
SPACE = 2.0**64


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Distinct hashes of all runs of ``words`` words, A-Z in lower case; of all words together if there are
    fewer; none without words."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(f"({WORD})"), 1)

    def runs(each: Column) -> Column:
        last = F.greatest(F.size(each) - words + 1, F.lit(1))
        hashes = F.transform(
            F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(each, i, words))
        )
        return F.when(F.size(each) == 0, F.array().cast("array<bigint>")).otherwise(
            F.array_distinct(hashes)
        )

    return let(F.transform(found, lambda word: F.xxhash64(word)), runs)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The sketch of a text; of a null or empty one, and of one without words, the empty array."""
    return smallest(shingle_hashes(F.coalesce(text, F.lit("")), words), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of what two sketches were made of, together."""
    return smallest(F.array_union(a, b), k)


def merge_by(frame: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group. Each task keeps at most ``k`` hashes of a group before the shuffle."""
    hashes = frame.select(*by, F.explode(column).alias("hash"))
    order = Window.partitionBy(*by).orderBy("hash")
    kept = hashes.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return kept.groupBy(*by).agg(F.sort_array(F.collect_set("hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either that both have; 1 if neither has any."""


    def share(both: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
        return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))

    return let(merge(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + SPACE / 2) / SPACE
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 if a has none."""
    total, own = distinct_shingles(merge(a, b, k), k), distinct_shingles(a, k)
    shared = resemblance(a, b, k) * total
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / own))


def as_text(a: Column) -> Column:
    """Base64 of the hashes, 8 bytes each, smallest first; empty for the empty sketch."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


def with_next(frame: DataFrame, key: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """Each row with columns of the next row in descending order of the key, and the last with the first's.

    Rows are dealt to ranges of the key that end at keys of the table, so each range also gets a copy of the
    rows that begin the range after it, and one window per range finds every neighbour. Null keys come last.
    Rows of one key are ordered by the columns.
    """
    spark = frame.sparkSession
    keyed = frame.withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    # At most `ranges` numbers, however large the table.
    found = keyed.agg(
        F.percentile_approx("_key", shares, 10 * ranges).alias("ends"), F.max("_key").alias("top")
    ).first()
    if found["top"] is None:
        ends = []
    else:
        ends = sorted({*found["ends"], found["top"]})
    bounds = F.array(*(F.lit(end) for end in ends)).cast("array<bigint>")
    # A range is numbered by the bounds below it. The rows of its largest key are copied to the range above,
    # those of the largest key of all to the lowest range; copies come after the range's own rows.
    own = F.size(F.filter(bounds, lambda end: end < F.col("_key")))
    here = F.struct(own.alias("range"), F.lit(False).alias("copy"))
    above = F.struct(((own + 1) % max(len(ends), 1)).alias("range"), F.lit(True).alias("copy"))
    dealt = keyed.withColumn(
        "_to",
        F.explode(
            F.when(F.array_contains(bounds, F.col("_key")), F.array(here, above)).otherwise(F.array(here))
        ),
    )
    order = Window.partitionBy("_to.range").orderBy(
        "_to.copy", F.desc("_key"), *(F.desc_nulls_last(c) for c in columns)
    )
    following = [F.lead(c).over(order).alias(prefix + c) for c in columns]
    return dealt.select("*", *following).where("not _to.copy").drop("_key", "_to")


def edited(frame: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of the rows (doc_id, text) and of their edited texts, and how alike they are.

    The edited text has, in place of its last floor(n/2) code points, the first as many (or all) of the text
    of the next document in descending order of doc_id, after the last the first. A null text is empty. Two
    texts without words are alike to degree 1, one with and one without to degree 0. Rows that repeat a
    doc_id follow each other, larger text first; a null doc_id is the smallest. A table of one row has that
    row as its own neighbour; an empty one gives no rows.
    """
    own = frame.withColumn("sketch", sketch(F.col("text"), k))
    near = with_next(own, "doc_id", ["text", "sketch"])
    half = F.floor(F.length("text") / 2).cast("int")
    new = F.concat(
        F.left("text", F.length("text") - half), F.left("next_text", half)
    )
    near = near.withColumn("edited", new).withColumn("edited_sketch", sketch(F.col("edited"), k))
    return near.select(
        "doc_id",
        "text",
        "edited",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
    )
