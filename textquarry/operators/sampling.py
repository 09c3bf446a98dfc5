"""Stratified samples, agreement with gold decisions, volume estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.storage import written


def round_robin(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` rows dealt over the strata in turn: ``id, stratum, round``.

    ``rows``: ``id, candidate_hash, stratum``.  Within a stratum rows come in order
    of a seeded hash; of rows with one candidate hash the first in that order
    stands for all.  The result depends neither on the order nor the partitioning
    of the input.  A stratum is cut to ``size`` rows before the strata meet.
    """
    rank = F.sha2(F.concat_ws("|", F.lit(str(seed)), "candidate_hash"), 256)
    ranked = rows.select("id", "candidate_hash", "stratum", rank.alias("rank"))
    once = ranked.groupBy("candidate_hash").agg(F.min(F.struct("rank", "stratum", "id")).alias("m")).select("m.rank", "m.stratum", "m.id")
    turn = F.row_number().over(Window.partitionBy("stratum").orderBy("rank", "id"))
    dealt = once.withColumn("round", turn).where(F.col("round") <= size)
    return dealt.orderBy("round", "stratum").limit(size).select("id", "stratum", "round")


def agreement(gold: DataFrame, reviews: DataFrame, least: float = 0.9) -> DataFrame:
    """One row: gold decisions, those reviewed, those matched, the share matched of all gold, and whether that passes.

    Passes only if every gold row is reviewed and at least ``least`` match.
    """
    theirs = reviews.select("id", F.col("decision").alias("theirs"))
    out = gold.join(theirs, "id", "left").agg(F.count(F.lit(1)).alias("gold"), F.count("theirs").alias("reviewed"), F.count_if(F.col("decision") == F.col("theirs")).alias("matches"))
    share = F.when(F.col("gold") > 0, F.col("matches") / F.col("gold")).otherwise(0.0)
    return out.withColumn("agreement", share).withColumn("passed", (F.col("reviewed") == F.col("gold")) & (F.col("gold") > 0) & (F.col("agreement") >= least))


def volume(rows: DataFrame, text: Column, *, overhead: int = 1500, price: float | None = None) -> DataFrame:
    """One row: examples, characters, bytes, tokens at four characters each plus an overhead an example, and a cost if a price a million is given."""
    n = F.count(F.lit(1))
    chars, size = F.coalesce(F.sum(F.length(text)), F.lit(0)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))
    tokens = F.floor((chars + 3) / 4).cast("long") + n * overhead
    out = rows.agg(n.alias("examples"), chars.cast("long").alias("characters"), size.cast("long").alias("bytes"), tokens.alias("estimated_tokens"))
    return out if price is None else out.withColumn("cost", F.col("estimated_tokens") / 1e6 * price)


def kept_top(rows: DataFrame, stratum: str, order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each stratum."""
    return written(rows.withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("place") <= k), "top")
