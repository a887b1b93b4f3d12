"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: its target share of the total, divided by its own share. A document's
count is the Poisson quantile, at that rate, of a number in [0, 1) hashed from seed and id, so a run can be repeated
and a document's count does not depend on partitions. Documents are exploded by count and sorted by a hashed key.

A null source is a source of its own; null and empty texts take part (a source's size is its characters, one at
least per document); repeated rows get equal counts, and so does every null id; an empty table gives an empty
result; other columns pass through, and names that clash with ``copy`` and ``shuffle_key`` are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzonal.llm.skew import attach_group, free_name
from gridzonal.storage import materialise

SEED = "mix-1"
TEMPERATURE = 0.5
EPOCHS = 1.0

ADDED = ("copy", "shuffle_key")


def _unit(*parts) -> F.Column:
    """A number in [0, 1) from 52 bits of a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("null")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint").cast("double") / 2**52


def repetition_rates(
    docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS
) -> DataFrame:
    """(source, n_docs, rate). ``weights`` has (source, weight); without it a source weighs size**temperature.

    The expected size of the mixture is ``epochs`` times the size of the input. A source that ``weights`` does not
    name has rate 0, and a named one that has no documents counts for nothing.
    """
    sizes = docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1))).alias("size"),
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        named = weights.select(F.col("source").alias("_named"), "weight")
        weighed = sizes.join(named, F.col("source").eqNullSafe(F.col("_named")), "left").fillna(0.0, ["weight"])
    weighed = materialise(weighed.select("source", "n_docs", "size", F.col("weight").cast("double")), "sources")
    total = weighed.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    share = F.col("weight") / F.col("all_weight") * (F.lit(epochs) * F.col("all_size") / F.col("size"))
    return weighed.join(F.broadcast(total)).select("source", "n_docs", F.coalesce(share, F.lit(0.0)).alias("rate"))


def poisson_steps(rate: F.Column) -> F.Column:
    """P(count <= k) for k = 0, 1, ... until the rest is below what a hashed number can tell apart."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log_p"), F.array(F.exp(-rate)).alias("steps"))

    def grow(state, k):
        log_p = state["log_p"] + F.ln(rate) - F.ln(k.cast("double"))
        steps = F.concat(state["steps"], F.array(F.element_at(state["steps"], -1) + F.exp(log_p)))
        return F.struct(log_p.alias("log_p"), steps.alias("steps"))

    counted = F.aggregate(F.sequence(F.lit(1), most), start, grow, lambda state: state["steps"])
    return F.when(rate > 0, counted).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 0) and ``shuffle_key``, in the order of the latter."""
    clash = set(ADDED) & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with columns of the operator")
    rates = repetition_rates(docs, weights, temperature, epochs)
    source, held, steps, unit, count = (free_name(docs, name) for name in ("_source", "_held", "_steps", "_u", "_count"))
    named = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null"))
    known = rates.select(named.alias(source), F.col("n_docs").alias(held), poisson_steps(F.col("rate")).alias(steps))
    keyed = docs.withColumn(source, named)
    drawn = attach_group(keyed, materialise(known, "rates"), source, held).withColumn(unit, _unit(F.lit(seed), "doc_id"))
    copies = drawn.withColumn(count, F.size(F.filter(steps, lambda step: step <= F.col(unit)))).filter(F.col(count) > 0)
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
    keyed = copies.withColumn("shuffle_key", _unit(F.lit(seed), F.lit("order"), "doc_id", "copy"))
    return keyed.select(*docs.columns, *ADDED).orderBy("shuffle_key", "doc_id", "copy")
