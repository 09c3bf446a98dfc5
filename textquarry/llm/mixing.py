"""Mixing sources to target weights by capped water-filling (DataFrame functions only).

Each source has a weight and a size in words.  The mix as a whole takes
``share`` times the words of all sources.  Source targets follow the weights,
stop at ``max_epochs`` times a source's own size, and what a stopped source
cannot take is shared again by weight until no target lies above its stop.

A target of ``w`` whole passes and a rest is sampled by a seeded hash: every
document is taken ``w`` times, and the documents of smallest hash once more
until the rest is reached.  The document at the edge is taken in part, so a
source's words equal its rounded target.  The hash depends on the seed, the
document's id and its size alone: reruns and other partitionings agree.

No source is gathered in one task: sizes are summed by source and hash bucket,
the bucket in which the rest ends is found from these sums, and documents are
put in order only inside that bucket (one of 4096 for each source).

Edge cases: a null or empty text, or one of white space only, has size 0 and is
taken 0 words; a null source is a source of its own, last in order; a null id
hashes like an empty one; rows that repeat are documents of their own; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.storage import written

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: DataFrame, *, share: float = 1.0, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source, size`` (one row a source) -> the same with ``weight`` and ``target``.

    Weights repeat ``cycle`` over the sources in code point order, null last.
    With stops in order of stop / weight, the stopped sources are a prefix:
    source i stops if its stop is at most its share of what the sources before
    it have left.  One pass over the sorted sources replaces the rounds of
    redistribution and gives the same targets.  Works on one row a source.
    """
    everything = Window.partitionBy()
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in cycle]), ((at - 1) % len(cycle) + 1).cast("int")).cast("double")
    t = sizes.select("source", "size", weight.alias("weight")).withColumn("stop", F.col("size").cast("double") * max_epochs)
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumns({
        "left_words": F.sum("size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("stop").over(earlier), F.lit(0.0)),
        "left_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
    })
    t = t.withColumn("stopped", F.col("stop") * F.col("left_weight") <= F.col("weight") * F.col("left_words"))
    t = t.withColumns({
        "rest_words": F.sum("size").over(everything) * F.lit(float(share)) - F.sum(F.when(F.col("stopped"), F.col("stop")).otherwise(0.0)).over(everything),
        "rest_weight": F.sum(F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(everything),
    })
    target = F.when(F.col("stopped"), F.col("stop")).otherwise(F.col("weight") * F.col("rest_words") / F.col("rest_weight"))
    return t.select("source", "size", "weight", target.alias("target"))


def mix(docs: DataFrame, *, seed: int = 17, share: float = 1.0, max_epochs: int = 3, cycle: tuple[int, ...] = (1, 2, 3), keep: list[str] | None = None) -> DataFrame:
    """One row a document: ``doc_id, source, size, source_size, target, taken`` and the columns in ``keep``, their names after ``keep_``.

    ``taken`` counts words with repeats; see the module for the method and the
    edge cases.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")).cast("binary"))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *[F.col(c).alias(f"keep_{c}") for c in keep or []])
    rows = rows.withColumn("draw", key)
    rows = rows.withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    narrow = written(rows, "mix-sizes")
    cells = written(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-cells")
    targets = water_fill(cells.groupBy("source").agg(F.sum("words").alias("size")), share=share, max_epochs=max_epochs, cycle=cycle)
    words = F.floor(F.col("target") + 0.5).cast("long")
    targets = written(targets.select(
        F.col("source").alias("t_source"), F.col("size").alias("source_size"), "target",
        F.when(F.col("size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div size")).otherwise(F.lit(0).cast("long")).alias("passes"),
        F.when(F.col("size") > 0, words % F.col("size")).otherwise(F.lit(0).cast("long")).alias("rest"),
    ), "mix-targets")
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = cells.select("source", "bucket", "words", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("before"))
    edges = edges.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).where("before < rest and rest <= before + words")
    edges = edges.select(F.col("t_source").alias("e_source"), F.col("bucket").alias("edge"), "before")
    plan = written(targets.join(edges, F.col("t_source").eqNullSafe(F.col("e_source")), "left").drop("e_source"), "mix-plan")
    rows = narrow.join(plan, F.col("source").eqNullSafe(F.col("t_source")))
    inside = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    whole = rows.where(~inside).withColumn("more", F.when(F.coalesce(F.col("bucket") < F.col("edge"), F.lit(False)), F.col("size")).otherwise(0))
    run = Window.partitionBy("source").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where(inside).withColumn("more", F.least(F.col("size"), F.greatest(F.lit(0), F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(run), F.lit(0)))))
    return whole.unionByName(cut).select("doc_id", "source", "size", "source_size", "target", (F.col("passes") * F.col("size") + F.col("more")).cast("long").alias("taken"), *[F.col(f"keep_{c}") for c in keep or []])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each whole pass repeats the row, the part at a source's edge is cut after its last word.

    Has the columns of ``docs``; ``n_chars``, where there is one, follows the
    text.  The cut copy's words are joined by single blanks.  Documents of size
    0 add no words to any mix and appear once.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "source")]
    rows = mix(docs, keep=others, **options)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.ceil(F.col("taken") / F.col("size")).cast("int"))
    rows = rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    left = F.col("taken") - (F.col("copy").cast("long") - 1) * F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("keep_text"), F.lit(WORD), F.lit(0)), F.lit(1), F.greatest(left, F.lit(1)).cast("int")), " ")
    rows = rows.withColumn("keep_text", F.when((left > 0) & (left < F.col("size")), cut).otherwise(F.col("keep_text")))
    if "n_chars" in others:
        rows = rows.withColumn("keep_n_chars", F.length("keep_text").cast("long"))
    return rows.select(*[F.col(f"keep_{c}" if c in others else c).alias(c) for c in docs.columns])
