"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Every source gets a share of the total in proportion to its weight. A source whose share exceeds
``max_epochs`` times its size is clamped there, and the excess is shared out again by weight until no
share is above its limit. A target is met by whole repetitions of every document, and by one further
repetition of a seeded sample: documents in the order of a seeded hash, up to the target. The document
at which the target falls gives a part of its words, so the words taken equal the rounded target.

At scale: the text is read to count words, sources are aggregated map-side, and the clamping rounds
bring one row to the driver each. The place in the hash order where a source's target falls is
found by two histograms of hash prefixes (at most 4096 sums a source), and only documents in
that one cell (1 in 16.7 million) are put in order, so a source may hold any share of the rows. The
per-source table is written, and Spark joins it by its size on file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import WORD

PREFIX = 3  # hexadecimal digits of a histogram cell


def word_count(text: Column) -> Column:
    """Words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_key(identifier: Column, seed: int) -> Column:
    """The seeded order of documents: hexadecimal, the same for the same identifier."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit(""))).cast("binary"))


def source_sizes(sized: DataFrame) -> DataFrame:
    """Words per source; documents without a source form one of their own."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights repeating over the sources by code point, null last.

    The rank is the number of sources in earlier ranges plus the rank within a range, so no task sees
    all sources.
    """
    ranged = sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "mix-ranges")
    before = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = before.select(  # one row per range
        "_range", (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(F.asc_nulls_last("source"))) - 1 + F.col("_before")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    made = ranged.join(before, "_range").withColumn("_rank", rank)
    return made.select("source", "source_size", F.get(listed, F.col("_rank") % len(weights)).alias("weight"))


def targets(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Water-filling: add ``target`` to (source, source_size, weight); targets sum to the total if the limits allow.

    Each round clamps the sources above their limit and shares what is left; clamped sources stay so,
    which ends the rounds. An empty source has target 0.
    """
    limit = F.col("source_size") * float(max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weight, n_clamped = float(total), None, -1
    while True:
        share = F.lit(None).cast("double") if weight is None else F.col("weight") * F.lit(left) / F.lit(weight)
        above = F.coalesce(share > limit, F.lit(False))
        row = sources.agg(
            F.sum(F.when(above, limit)).alias("taken"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row["n"] == n_clamped:
            break
        n_clamped, left, weight = row["n"], total - (row["taken"] or 0.0), row["weight"] or 0.0
        if weight <= 0:
            return sources.withColumn("target", limit)
    return sources.withColumn("target", F.least(limit, share))


def sampling_plan(sized: DataFrame, weighted: DataFrame, max_epochs: int, seed: int) -> DataFrame:
    """Per source: whole repetitions, and the cell of the hash order where the further one ends.

    Columns: source, source_size, target, whole, part (words of the further repetition), cell1, cell2,
    before (words of that source in earlier cells). Written to the shared folder.
    """
    budget = F.round("target").cast("long")
    size = F.when(F.col("source_size") > 0, F.col("source_size"))
    planned = targets(weighted, max_epochs)
    planned = planned.withColumn("whole", F.coalesce(F.floor(budget / size).cast("long"), F.lit(0).cast("long")))
    planned = planned.withColumn("part", budget - F.col("whole") * F.col("source_size"))
    planned = materialise(planned, "mix-targets")

    keyed = sized.select("source", "size", draw_key(F.col("doc_id"), seed).alias("key"))
    cells = keyed.select("source", "size", F.substring("key", 1, PREFIX).alias("cell1"), F.substring("key", PREFIX + 1, PREFIX).alias("cell2"))
    first = _cell(cells.groupBy("source", "cell1").agg(F.sum("size").alias("words")), planned, "cell1", F.lit(0))
    inside = cells.join(first.select(F.col("source").alias("s"), F.col("cell1").alias("c")), F.col("source").eqNullSafe(F.col("s")) & (F.col("cell1") == F.col("c")))
    sums = inside.groupBy("source", "cell2").agg(F.sum("size").alias("words"))
    second = _cell(sums, first, "cell2", F.col("before"))
    left, right = planned.alias("p"), second.select("source", "cell1", "cell2", "before").alias("c")
    plan = left.join(right, F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    return materialise(plan.select("p.source", "source_size", "target", "whole", "part", "cell1", "cell2", "before"), "mix-plan")


def _cell(sums: DataFrame, plan: DataFrame, cell: str, base: Column) -> DataFrame:
    """The cell of each source in which its part ends, and the words before it."""
    named = plan.withColumnRenamed("source", "s").withColumn("_base", base).drop("before")
    joined = sums.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    order = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
    running = joined.withColumn("_to", F.col("_base") + F.sum("words").over(order))
    ends = (F.col("_to") >= F.col("part")) & (F.col("_to") - F.col("words") < F.col("part"))
    return running.filter(ends).withColumn("before", F.col("_to") - F.col("words")).drop("_to", "_base", "words")


def take(sized: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Add to every row of (doc_id, source, size, ...) what the mix takes of it.

    Added: source_size, target, ``repeats`` (whole copies), ``part_words`` (words of one further, partial
    copy; 0 for all but one document a source), ``taken`` (words in all).
    """
    named = plan.withColumnRenamed("source", "_s")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_key", draw_key(F.col("doc_id"), seed))
    cell, end = F.substring("_key", 1, 2 * PREFIX), F.concat("cell1", "cell2")
    at_end = F.coalesce(cell == end, F.lit(False))
    order = Window.partitionBy("source").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    earlier = rows.filter(~at_end).withColumn("_more", F.when(F.coalesce(cell < end, F.lit(False)), F.col("size")).otherwise(F.lit(0)))
    ending = rows.filter(at_end).withColumn("_more", F.sum("size").over(order) - F.col("size") + F.col("before"))
    ending = ending.withColumn("_more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("_more"))))
    whole_more = (F.col("_more") == F.col("size")) & (F.col("size") > 0)
    return (
        earlier.unionByName(ending)
        .withColumn("repeats", F.col("whole") + F.when(whole_more, 1).otherwise(0))
        .withColumn("part_words", F.when(whole_more, 0).otherwise(F.col("_more")).cast("long"))
        .withColumn("taken", (F.col("repeats") * F.col("size") + F.col("part_words")).cast("long"))
        .drop("_key", "_more", "cell1", "cell2", "before", "whole", "part")
    )


def mix(docs: DataFrame, weights: Sequence[float], max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """What a mix of all ``docs`` (doc_id, source, text) takes of each: one row per row of the input.

    Weights repeat over the sources by code point, null last. Null and empty texts have size 0 and give
    nothing; repeated rows are rows like any other; an empty table gives an empty result; other
    columns are ignored. Reruns with the same seed agree.
    """
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    plan = sampling_plan(sized, cyclic_weights(source_sizes(sized), weights), max_epochs, seed)
    return take(sized, plan, seed)


def mixed_documents(docs: DataFrame, weights: Sequence[float], max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The mixed documents themselves: every row as often as the mix takes it, all columns kept.

    A partial copy holds the first ``part_words`` words of its text, and its ``n_chars`` is that text's
    length. Documents without a word are not repeated: one row each stays.
    """
    size = word_count(F.col("text"))
    sized = materialise(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    plan = sampling_plan(sized, cyclic_weights(source_sizes(sized), weights), max_epochs, seed)
    rows = docs.select("doc_id", "source", size.alias("size"), F.struct(*docs.columns).alias("_row"))
    taken = take(rows, plan, seed)
    copies = F.greatest(F.col("repeats"), F.when(F.col("size") == 0, 1).otherwise(0))
    whole = taken.withColumn("_copies", copies).filter("_copies > 0")
    whole = whole.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
    begin = F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col("part_words").cast("int"))
    part = taken.filter("part_words > 0").select("_row.*", F.array_join(begin, "").alias("_text"))
    replaced = {"text": F.col("_text")} | ({"n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return whole.unionByName(part.withColumns(replaced).drop("_text"))
