"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

Every source has a weight; the sources share the corpus's words by weight, a source gives at
most ``limit`` times its own words, and what it cannot give is shared again by weight. Over
training time a source's rate runs linearly from ``1 - slope`` to ``1 + slope`` of its mean (the
earliest source in code-point order falls, the last one rises). The integral of that
schedule is the source's cumulative demand; its inverse gives each pass over each document its
training position in ``[0, 1]``, and documents are range-sorted by their first position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.frames import cut, prefix_sums, word_count

#: Weights of the sources in code-point order (null last), repeating.
WEIGHT_CYCLE = 3
#: Most passes over a source.
LIMIT = 3
#: Largest change of a source's rate against its mean.
SLOPE = 0.5


def source_targets(sized: DataFrame, limit: int = LIMIT, slope: float = SLOPE) -> DataFrame:
    """One row per source: ``source, source_size, target, demand, drift``.

    A source is full if its limit is at most its share once all fuller ones are full
    (sources ordered by limit per weight), which is where sharing again and again ends.
    The windows see one aggregated row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = totals.select(
        "source", "source_size", (F.row_number().over(by_name) - 1).alias("rank"),
        F.count(F.lit(1)).over(everything).alias("n"), F.sum("source_size").over(everything).alias("total"))
    weighted = ranked.withColumn("weight", 1 + F.col("rank") % WEIGHT_CYCLE).withColumn("most", limit * F.col("source_size"))
    order = [F.col("most") / F.col("weight"), F.col("rank")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
    level = weighted.withColumn("full", F.col("most") * F.sum("weight").over(after) <= left * F.col("weight"))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    taken_by_full = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0))
    share = (F.col("total") - taken_by_full).cast("double") * F.col("weight") / open_weight
    return (level.withColumn("target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(share))
            .select("source", "source_size", "target", F.floor("target").cast("long").alias("demand"),
                    F.when(F.col("n") > 1, F.lit(slope) * (2.0 * F.col("rank") / (F.col("n") - 1) - 1.0))
                    .otherwise(F.lit(0.0)).alias("drift")))


def position(words_before, demand, drift):
    """The time ``t`` at which the demand ``(1 - drift) t + drift t**2`` of a source has reached a share of its words."""
    u = F.least(words_before / demand, F.lit(1.0))
    return 2.0 * u / ((1.0 - drift) + F.sqrt((1.0 - drift) * (1.0 - drift) + 4.0 * drift * u))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        limit: int = LIMIT, slope: float = SLOPE, carry: list[str] | None = None) -> DataFrame:
    """One row per document, sorted by first training position (documents not taken come last).

    ``doc_id, size`` (words; 0 for null or empty texts), ``source, source_size, target, taken``
    (words the mix takes, repeats counted), ``passes`` (how often the document is
    read; a last pass counts from half of its words on), ``position`` (null if not taken), and the
    source's ``demand`` and ``drift``.
    A source's documents are passed over in a fixed pseudo-random order of their ids until its
    demand is met, so its taken words miss the target by less than one word. Null is a source
    of its own; repeated rows count each time; a null id has a fixed place. An empty
    table gives no rows. The columns of ``carry`` are added as they are; further columns are not read.
    """
    carry = carry or []
    sized = cut(docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), docs[text].alias("text"), *[docs[c] for c in carry])
                .select("doc_id", "source", word_count("text").alias("size"), *carry))
    placed = prefix_sums(sized, "source", "doc_id", "size", "before")
    targets = source_targets(sized, limit, slope).withColumnRenamed("source", "__source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("demand") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("demand") - F.col("whole") * F.col("source_size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("rest") - F.col("before")))
    middle = F.col("before") + F.when(F.col("whole") > 0, F.col("size")).otherwise(F.col("last")) / 2.0
    return (joined.withColumn("whole", whole).withColumn("rest", rest).withColumn("last", last)
            .withColumn("taken", F.col("whole") * F.col("size") + F.col("last"))
            .withColumn("passes", F.col("whole") + (2 * F.col("last") >= F.greatest(F.col("size"), F.lit(1))).cast("long"))
            .withColumn("position", F.when(F.col("taken") > 0, position(middle, F.col("demand"), F.col("drift"))))
            .select("doc_id", "size", "source", "source_size", "target", "taken", "passes", "position", "demand", "drift", *carry)
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                limit: int = LIMIT, slope: float = SLOPE, carry: list[str] | None = None) -> DataFrame:
    """``doc_id, source, pass, position`` (and the columns of ``carry``): one row for each reading of a document that ``mix`` counts in ``passes``.

    Later passes lie a whole round of the source's words behind the first one.
    """
    mixed = mix(docs, doc_id, text, source, limit, slope, carry).where(F.col("passes") > 0)
    again = mixed.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    first = F.col("demand") * ((1.0 - F.col("drift")) * F.col("position") + F.col("drift") * F.col("position") * F.col("position"))
    later = position(first + F.col("pass") * F.col("source_size"), F.col("demand"), F.col("drift"))
    return again.select("doc_id", "source", "pass", F.when(F.col("pass") == 0, F.col("position")).otherwise(later).alias("position"), *(carry or []))
