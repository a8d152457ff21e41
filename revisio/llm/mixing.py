"""Mixing sources to target weights, in native expressions.

Targets are water-filled: sources share all words by weight, none takes more than `epochs`
times its own words, and what a full source leaves is shared again by weight. Inside a
source, rows stand in the order of a hash-random key. The key's leading digits deal them to
ranges; range totals give each range its prefix sum, and a window inside a range gives each
row's. A source that holds most rows is therefore spread over all ranges. The cut is at the
source's exact budget: whole passes over the source, then a last pass that ends inside the
row where the budget is used up.

Defined results. Null text: size 0. Null source: the last source in order. Ties of the key
(repeated ids) order by size, then by the text's hash; rows equal in all that are alike.
A source without words: target 0. Empty table: no rows. Other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisio.plans.lineage import Scratch

EPOCHS, WEIGHTS, WORD = 3, (1, 2, 3), r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source: a key that sorts in their order, source_size) to (source, source_size, target). One row per source; runs in one task.

    Sources fill in the order of epochs * size / weight. The level of those that stay below
    their limit is (total - limits of the full ones) / (weights of the others), at the first
    place in the order where the next source's limit is not under the level.
    """
    limit, ratio = F.lit(epochs).cast("long") * F.col("source_size"), F.col("full_at")
    by_name = Window.orderBy("source")
    numbered = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")).withColumn("full_at", (limit / F.col("weight")).cast("double"))
    all_of, before = Window.partitionBy(), Window.orderBy("full_at", "source").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_of) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    share = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = numbered.withColumn("level", (rest / share).cast("double"))
    level = F.min(F.when(F.col("level") <= ratio, F.struct(ratio, F.col("level").alias("level")))).over(all_of)["level"]
    return levels.withColumn("level", level).select("source", "source_size", F.least(limit.cast("double"), F.col("level") * F.col("weight")).alias("target"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All rows and columns, with what the mix needs of each: size, source, key, and a hash of the text for ties."""
    name = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    return docs.withColumns({"mix_size": words(F.col(text_col)), "mix_source": name, "mix_key": F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), "mix_tie": F.xxhash64(F.col(text_col))})


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options: object) -> DataFrame:
    """All rows and columns, with mix_size, mix_source_size, mix_target, mix_passes, mix_taken (words taken, repeats counted). options: those of `placed`."""
    return placed(sized(docs, id_col, text_col, source_col), docs.columns, **options)


def placed(rows: DataFrame, keep: list[str], *, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, digits: int = 3) -> DataFrame:
    """The mix of sized rows; keep: columns that stay.

    digits: hexadecimal digits of the key that deal rows to ranges (16**digits a source).
    """
    rows = rows.withColumn("mix_range", F.substring("mix_key", 1, digits))
    ranges = rows.groupBy("mix_source", "mix_range").agg(F.sum("mix_size").alias("size"))
    goals = targets(ranges.groupBy(F.col("mix_source").alias("source")).agg(F.sum("size").alias("source_size")), weights, epochs)
    before = F.coalesce(F.sum("size").over(Window.partitionBy("mix_source").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    begins = ranges.withColumn("mix_begin", before).join(goals.withColumnsRenamed({"source": "mix_source", "source_size": "mix_source_size", "target": "mix_target"}), "mix_source").drop("size")
    in_range = Window.partitionBy("mix_source", "mix_range").orderBy("mix_key", "mix_size", "mix_tie").rowsBetween(Window.unboundedPreceding, -1)
    in_order = rows.withColumn("mix_place", F.coalesce(F.sum("mix_size").over(in_range), F.lit(0).cast("long")))
    joined = in_order.join(begins, ["mix_source", "mix_range"])
    budget, whole = F.floor("mix_target").cast("long"), F.col("mix_source_size")
    passes = F.when(whole > 0, F.floor(F.try_divide(budget, whole))).otherwise(0).cast("long")
    last = F.least(F.col("mix_size"), F.greatest(F.lit(0).cast("long"), budget - passes * whole - F.col("mix_begin") - F.col("mix_place")))
    return joined.select(*keep, "mix_size", "mix_source_size", "mix_target", passes.alias("mix_passes"), (passes * F.col("mix_size") + last).alias("mix_taken"))


def digests(docs: DataFrame, **options: object) -> DataFrame:
    """Texts are read once: what the mix needs of a row is written, and read twice."""
    rows = Scratch(docs.sparkSession, "mix").cut(sized(docs.select("doc_id", "source", "text")).drop("text"), "sized")
    return placed(rows, ["doc_id"], **options).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


def mixture(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars", **options: object) -> DataFrame:
    """The mix itself, with the columns of the input: a row for each whole pass that takes it, and one with the words up to the cut.

    length_col (if there is one) follows the text. Columns pass under names of their own, so
    that none clashes with what the mix adds.
    """
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    keep, text = list(names.values()), names[text_col]
    mixed = mix(docs.toDF(*keep), id_col=names[id_col], text_col=text, source_col=names[source_col], **options)
    rest = (F.col("mix_taken") - F.col("mix_passes") * F.col("mix_size")).cast("int")
    whole = (F.col("mix_passes") + (rest.cast("long") == F.greatest(F.col("mix_size"), F.lit(1))).cast("long")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.when((rest > 0) & (rest < F.col("mix_size")), F.array(rest)).otherwise(F.array().cast("array<int>")))
    runs = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)  # white space, then a word
    head = F.array_join(F.slice(runs, F.lit(1), F.col("mix_copy")), "")
    cut = F.col("mix_copy") >= 0
    out = mixed.withColumn("mix_copy", F.explode(copies))
    if length_col in names:
        at = names[length_col]
        out = out.withColumn(at, F.when(cut, F.length(head)).otherwise(F.col(at)).cast(out.schema[at].dataType))
    return out.withColumn(text, F.when(cut, head).otherwise(F.col(text))).select(*keep).toDF(*names)
