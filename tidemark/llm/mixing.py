"""Mix sources to target weights by Poisson replication.

Each document is repeated as often as a Poisson variable says whose mean is its
source's repetition rate: target share of bytes over present share. The variable
comes from a hash of seed, id, text and piece, by inversion, so a lost task draws
the same again. The copies are then dealt out and ordered by another hash: a
uniform shuffle of the whole corpus with one exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import closed, column, looked_up, opened

#: Means above this are drawn as a sum of independent pieces, for exp(-mean) to stay exact.
PIECE = 64.0
#: Terms of the distribution up to which a piece is inverted; the rest weighs under 1e-30.
TERMS = 192


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the md5 of the parts joined by colons."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def repetition_rates(docs: DataFrame, weights: DataFrame | None, source: str, text: str, exponent: float) -> DataFrame:
    """One row per source: ``source``, ``mix_rate``.

    Weights are ``(source, weight)`` rows; without them a source's weight is its bytes
    to the power ``exponent``. A source without a weight or with none above 0 gets rate 0.
    """
    sizes = docs.groupBy(column(source).alias("source")).agg(
        F.sum(F.octet_length(F.coalesce(column(text), F.lit(""))) + 1).cast("double").alias("bytes")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("bytes", F.lit(exponent)))
    else:
        given = weights.groupBy(F.col("source").alias("name")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        weighed = sizes.join(given, sizes["source"].eqNullSafe(given["name"]), "left").drop("name")
    weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    totals = weighed.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    rate = F.coalesce(F.try_divide(F.col("weight") * F.col("all_bytes"), F.col("all_weight") * F.col("bytes")), F.lit(0.0))
    return weighed.crossJoin(F.broadcast(totals)).select("source", rate.alias("mix_rate"))


def distribution(mean: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2, ... as an array."""
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("sums"))

    def grow(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        return F.struct(term.alias("term"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + term)).alias("sums"))

    steps = F.sequence(F.lit(1), F.lit(TERMS))
    # Sums that no draw can pass, or that rounding has stopped, are not needed.
    return F.filter(F.array_distinct(F.aggregate(steps, start, grow, lambda s: s["sums"])), lambda s: s < 1.0)


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    seed: int = 17,
    exponent: float = 0.5,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Documents repeated to the target weights, in a global random order.

    Returns the input's columns and ``mix_copy`` (1, 2, ... per row), ``mix_rate`` and
    ``mix_order`` (rows sorted by it are in shuffled order; every partition holds a
    uniform sample, sorted). Columns of these names in the input are replaced.

    Empty table: empty. Null source: a source of its own. Null or empty text: counts one
    byte in its source's size. Ids and texts decide the draws together, so rows of one id
    and different texts draw and are dealt apart, and a null id is drawn by the text. Rows
    equal in both draw alike and are kept as often as they come. Long texts are one row as
    any other.
    """
    rates = repetition_rates(docs, weights, source, text, exponent)
    pieces = F.greatest(F.ceil(F.col("mix_rate") / PIECE), F.lit(1)).cast("int")
    rates = rates.withColumn("pieces", pieces).withColumn("sums", distribution(F.col("mix_rate") / F.col("pieces")))
    rows = opened(docs, id=column(doc_id), source=column(source), text_id=F.md5(F.coalesce(column(text).cast("string"), F.lit(""))))
    rows = looked_up(rows, rates, "source", F.struct("id", "text_id"))

    def draw(piece: Column) -> Column:
        at = uniform(F.lit(seed), F.col("id"), F.col("text_id"), piece)
        return F.size(F.filter(F.col("sums"), lambda s: s <= at))

    count = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("pieces")), draw), F.lit(0), lambda a, b: a + b)
    copies = rows.withColumn("count", count).drop("sums", "pieces").filter("count > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count"))))
    copies = copies.withColumn("order", uniform(F.lit(f"order {seed}"), F.col("id"), F.col("text_id"), F.col("copy")))
    shuffled = copies.repartition(F.col("order")).sortWithinPartitions("order")
    return closed(
        shuffled, docs.columns, mix_copy=F.col("copy"), mix_rate=F.col("mix_rate"), mix_order=F.col("order")
    )
