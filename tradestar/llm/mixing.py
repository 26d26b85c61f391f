"""Mixing sources to target weights by Poisson replication.

The mean repetition rate of a source is its share of the target over its share of
the input, both in code points of text.  A hash of seed and document gives a
uniform number, the inverse of the source's Poisson distribution at that number
gives the document's number of copies, and the exploded copies are dealt out and
ordered by a hash of their own.  Rates above ``SPLIT_RATE`` are the sum of several
draws, so none is out of floating-point range and no rate is capped.

Defined cases: a null source is a source like any other; a source without any text
has rate 1; sources missing from given weights have weight 0; a null doc_id draws
by its text instead; repeated rows draw the same number; an empty table, or one
without any text, is handled alike (rate 1).  Result columns replace input columns
of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.common import numbered, without
from tradestar.session import materialize

SEED = 42
#: Weight of a source is its size to this power unless weights are given.
FLATTEN = 0.5
#: Size of the mix over size of the input.
EPOCHS = 1.0
SPLIT_RATE = 64.0
#: The hash has 52 bits, and beyond mean + 12 deviations + 30 nothing of a Poisson distribution is left at that grain.
GRAIN = float(2**52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS, flatten: float = FLATTEN, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(source_col, rate)``: mean number of copies of a document of each source."""
    sizes = materialize(docs.groupBy(source_col).agg(F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).cast("double").alias("size")), "mix_sizes")
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(flatten)))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), f"_source {docs.schema[source_col].dataType.simpleString()}, weight double")
        weighed = sizes.join(F.broadcast(given), F.col(source_col).eqNullSafe(F.col("_source")), "left").select(source_col, "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    all_size, all_weight = (x or 0.0 for x in weighed.agg(F.sum("size"), F.sum("weight")).first())
    rate = F.col("weight") / F.lit(all_weight or 1.0) * F.lit(all_size) * F.lit(epochs) / F.col("size")
    return weighed.select(source_col, F.when((F.col("size") > 0) & F.lit(all_weight > 0), rate).otherwise(1.0).alias("rate"))


def _distribution(rate: Column) -> Column:
    """P(at most k copies) for k = 0, 1, ... as an array."""
    steps = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int"))
    start = F.exp(-rate)
    first = F.struct(start.alias("p"), F.array(start).alias("c"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    return F.aggregate(steps, first, add, lambda s: s["c"])


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *parts))


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, seed: int = SEED, epochs: float = EPOCHS, flatten: float = FLATTEN, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with each row repeated, and copy (from 1), n_copies and mix_key; dealt out and sorted by mix_key."""
    rest = without(docs, "copy", "n_copies", "mix_key")
    names = rest.columns
    rest, (id_col, source_col, text_col) = numbered(rest, id_col, source_col, text_col)
    plan = rates(rest, weights, epochs, flatten, source_col, text_col)
    draws = F.greatest(F.ceil(F.col("rate") / SPLIT_RATE), F.lit(1)).cast("int")
    plan = plan.withColumn("draws", draws).select(F.col(source_col).alias("_source"), "draws", _distribution(F.col("rate") / F.col("draws")).alias("below"))
    # one row for each source: stored, so that its size decides whether it is broadcast
    plan = materialize(plan, "mix_rates").select("_source", F.col("draws").alias("_draws"), F.col("below").alias("_below"))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")))))

    def draw(j: Column) -> Column:
        u = F.conv(F.substring(_hash(F.lit(str(seed)), name, j.cast("string")), 1, 13), 16, 10).cast("double") / GRAIN
        return F.aggregate("_below", F.lit(0), lambda n, b: n + F.when(b <= u, 1).otherwise(0))

    n = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_draws")), draw), F.lit(0), lambda a, x: a + x)
    counted = rest.join(plan, F.col(source_col).eqNullSafe(F.col("_source"))).withColumn("n_copies", n)
    copies = F.when(F.col("n_copies") > 0, F.sequence(F.lit(1), F.col("n_copies"))).otherwise(F.array().cast("array<int>"))
    spread = counted.withColumn("copy", F.explode(copies)).withColumn("mix_key", _hash(F.lit(f"{seed} order"), name, F.col("copy").cast("string")))
    dealt = spread.select(*rest.columns, "copy", "n_copies", "mix_key").repartition("mix_key").sortWithinPartitions("mix_key")
    return dealt.toDF(*names, "copy", "n_copies", "mix_key")
