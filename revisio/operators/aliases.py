"""Canonical ids of aliased source ids [K4]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisio.operators.components import connected_components
from revisio.plans.lineage import Scratch


def _edges(accepted: DataFrame) -> DataFrame:
    """Distinct (a, b): each id with each of its aliases, or with null. A blank id fails the query."""
    edges = accepted.select("source_event_id", F.explode_outer("associated_ids").alias("alias")).distinct()
    blank = lambda c: ~F.coalesce(F.col(c).rlike(r"(?U)\S"), F.lit(False))
    guard = F.when(blank("source_event_id") | (F.col("alias").isNotNull() & blank("alias")), F.raise_error(F.lit("blank source id")).cast("string")).otherwise(F.col("source_event_id"))
    return edges.select(guard.alias("a"), F.col("alias").alias("b"))


def canonical_ids(accepted: DataFrame) -> DataFrame:
    """(source_event_id, canonical_id) of every id that accepted rows name, alone or as an alias.

    The canonical id is the least id of the component. A blank id fails the query.
    """
    return components_of(_edges(accepted))


def added(labels: DataFrame, accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What new accepted rows change of stored labels (source_event_id, canonical_id): (labels that are new or others, old canonical ids with their new ones).

    New edges run between the components that are stored already, so that only these and what
    the new rows name take part, not the edges of the past. Stored labels are the canonical
    ids of all accepted rows before; both together give those of all rows.
    """
    edges = Scratch(accepted.sparkSession, "aliases").cut(_edges(accepted), "edges")
    ids = edges.select(F.explode(F.array("a", "b")).alias("source_event_id")).where("source_event_id IS NOT NULL").distinct()
    named = Scratch(accepted.sparkSession, "aliases").cut(ids.join(labels, "source_event_id", "left").select("source_event_id", F.coalesce("canonical_id", "source_event_id").alias("node"), F.col("canonical_id").isNull().alias("new")), "named")
    end = lambda c: named.select(F.col("source_event_id").alias(c), F.col("node").alias(f"{c}_node"))
    between = edges.join(end("a"), "a").join(end("b"), "b", "left").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    found = Scratch(accepted.sparkSession, "aliases").cut(components_of(between).withColumnRenamed("source_event_id", "node"), "found")
    moved = found.where("node <> canonical_id").select(F.col("node").alias("old_id"), F.col("canonical_id").alias("new_id"))
    fresh = named.where("new").join(found, "node").select("source_event_id", "canonical_id")
    relabelled = labels.join(moved, labels["canonical_id"] == moved["old_id"]).select("source_event_id", F.col("new_id").alias("canonical_id"))
    return fresh.union(relabelled), moved


def components_of(edges: DataFrame) -> DataFrame:
    """Labels of all vertices of (a, b), those with self-loops or without partners included."""
    vertices = edges.select(F.explode(F.array("a", "b")).alias("source_event_id")).where("source_event_id IS NOT NULL").distinct()
    found = connected_components(edges)
    return vertices.join(found.withColumnRenamed("node", "source_event_id"), "source_event_id", "left").select("source_event_id", F.coalesce("component", "source_event_id").alias("canonical_id"))
