"""Vocabulary paths to hierarchy edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptree.session import materialize


def path_decode(hier: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Distinct (parent_aui, aui) edges from (aui, ptr) rows.

    ``ptr`` lists a node's ancestors from the root down, dot-separated, the node itself
    not among them; the root's parent is ''. A path contributes an edge between each two
    neighbours. The node hangs under the last ancestor of its longest path; equal lengths
    give several parents. A path's end counts as one step longer than the ancestor it
    repeats, but with the smallest position at which that end occurs on any of the node's
    paths. With ``max_tokens`` only that many first ancestors of a path are read.
    """
    whole = F.split(F.col("ptr"), r"\.")
    closed = F.col("ptr").endswith(".")  # a final dot: nothing follows, the end is not repeated
    names = F.transform(F.when(closed, F.slice(whole, 1, F.size(whole) - 1)).otherwise(whole), lambda step: F.trim(step))
    steps = F.when(closed | (F.col("ptr") == ""), names).otherwise(F.concat(names, F.slice(names, -1, 1)))
    kept = F.col("steps") if max_tokens is None else F.slice(F.col("steps"), 1, max_tokens)

    found = materialize(
        hier.where(F.col("ptr").isNotNull())
        .select("aui", steps.alias("steps"))
        .select("aui", kept.alias("steps"))
        .select("aui", "steps", F.posexplode("steps").alias("position", "code"))
        .select(
            "aui",
            "code",
            F.when(F.col("position") == 0, "").otherwise(F.try_element_at("steps", F.col("position"))).alias("before"),
            "position",
        )
        .groupBy("aui", "code", "before")
        .agg(F.min("position").alias("position")),
        "steps",
    )
    between = found.where("code <> before").select(F.col("before").alias("parent_aui"), F.col("code").alias("aui"))
    # The deepest position is looked up by join, not in a window: a node with very many
    # paths is not gathered in one task.
    deepest = found.groupBy("aui").agg(F.max("position").alias("position"))
    ends = found.join(deepest, ["aui", "position"]).select(F.col("code").alias("parent_aui"), "aui")
    return between.union(ends).distinct()
