"""Mixing sources to target weights by weighted sampling.

Every document gets an exponential key divided by its quality weight, so that the
smallest keys are a weighted sample without replacement (Efraimidis and
Spirakis). A source first gives all its documents as often as its target holds
them completely, and then those with the smallest keys until the rest is filled.

The prefix sums need no sort of a whole source. Keys fall into buckets, bucket
sums show which bucket the budget ends in, and only that bucket is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.tables import BLANKS, blank_words
from granero.sources.staging import stage

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
ROWS_PER_BUCKET = 256


def uniform(identity: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the identity's text and the seed alone."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(identity.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (number + 0.5) / F.lit(float(1 << 52))


def quality_weight(text: Column) -> Column:
    """Words per word and sign: 1 for plain prose, less with signs such as # or |."""
    given = F.coalesce(text, F.lit(""))
    words = F.size(blank_words(given)).cast("double")
    signs = F.regexp_count(given, F.lit("[#*$%&|<>]"))
    return F.when(words > 0, words / (words + signs)).otherwise(F.lit(1.0))


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, weigh ``weights`` in turn and share the
    sum of all sizes. A target above ``most_epochs`` times its source's size stops
    there, and the excess is shared by weight until none is above. With sources in
    order of cap / weight, that level is the largest of the shares each source
    would see if those before it were capped. One task sees one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*(F.lit(weight) for weight in weights))
    weighed = sources.withColumn("_weight", kinds[F.pmod(turn, F.lit(len(weights)))]).withColumn(
        "_cap", F.col("source_size") * most_epochs
    )
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ).cast("double") / F.sum("_weight").over(rest)
    return (
        weighed.withColumn("_share", share)
        .withColumn("_level", F.max("_share").over(everything))
        .withColumn("target", F.least(F.col("_level") * F.col("_weight"), F.col("_cap").cast("double")))
        .drop("_weight", "_cap", "_share", "_level")
    )


def mix(
    docs: DataFrame,
    quality: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: int = 17,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    also: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of every document.

    ``docs`` has doc_id, text and source; other columns are read only by
    ``quality``, the weight above 0 of a document. Result: doc_id, source, size
    (words, 0 for null), source_size, target, taken (words, repeats counted),
    copies, and the columns named in ``also``. The document that the budget ends in is taken if that comes nearer to
    the target. A null source is a source of its own; repeated rows are documents
    of their own and equal ones may be told apart either way. An empty table gives
    an empty result.
    """
    weight = quality_weight(F.col("text")) if quality is None else quality
    keyed = stage(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.size(blank_words(F.col("text"))).cast("bigint").alias("size"),
            (-F.log(uniform(F.col("doc_id"), seed)) / weight).alias("_key"),
            *also,
        )
    )
    per_source = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    )
    plan = stage(
        targets(per_source, weights, most_epochs)
        .withColumn(
            "_epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)),
        )
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_buckets", F.ceil(F.col("_rows") / rows_per_bucket))
        .drop("_rows")
        .withColumnRenamed("source", "_source")
    )
    placed = (
        keyed.join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * F.col("_buckets")))
        .drop("_source", "_buckets")
    )
    so_far = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        placed.groupBy(F.col("source").alias("_s"), F.col("_bucket").alias("_b"))
        .agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(so_far), F.lit(0)))
    )
    here = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))
    known = placed.join(buckets, here).drop("_s", "_b")
    ends = (F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.col("_before") + F.sum("size").over(upto)
    cut = known.where(ends).withColumn("_more", (2 * after - F.col("size") < 2 * F.col("_rest")).cast("int"))
    clear = known.where(~ends).withColumn(
        "_more", (F.col("_before") + F.col("_words") <= F.col("_rest")).cast("int")
    )
    copies = (F.col("_epochs") + F.col("_more")).cast("int")
    return cut.unionByName(clear).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
        *also,
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, with all their columns, as often as it takes them."""
    nested = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"))
    numbered = stage(nested.withColumn("_at", F.monotonically_increasing_id()))
    named = numbered.select("_at", *(F.col(f"_row.{name}").alias(name) for name in ("doc_id", "text", "source")))
    taken = mix(named, also=["_at"], **options).where(F.col("copies") > 0)
    copies = taken.select(F.col("_at").alias("_to"), "copies")
    return (
        numbered.join(copies, F.col("_at") == F.col("_to"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("_row.*")
    )
