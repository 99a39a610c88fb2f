"""Levels, closures, and links of a hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.functions.tables import doubled, flag, iterate, restrict, union_all, update_from
from conceptree.session import materialize


def hierarchy_levels(
    concept: DataFrame,
    concept_relationship: DataFrame,
    root_id: int = fixed.LAB_ROOT_CONCEPT_ID,
    vocabulary: str = fixed.LAB_VOCABULARY,
    relationship: str = fixed.LAB_RELATIONSHIP,
) -> DataFrame:
    """Everything below the root: one row per (parent, child) with its smallest depth.

    Columns parent_concept_id, parent_concept_name, depth, concept_id, concept_code,
    concept_name. The root has depth 1 and no parent.
    """
    members = concept.where(F.col("vocabulary_id") == vocabulary).select("concept_id", "concept_code", "concept_name")
    edges = materialize(
        concept_relationship.where(F.col("relationship_id") == relationship)
        .where("concept_id_1 <> concept_id_2")
        .select(F.col("concept_id_2").alias("parent"), F.col("concept_id_1").alias("concept_id"))
        .join(members.select("concept_id"), "concept_id", "left_semi")
        .select("parent", F.col("concept_id").alias("child"))
        .distinct(),
        "edges",
    )
    # Only the depths of parents are asked for, so the steps go over links between parents.
    parents = materialize(edges.select("parent").distinct(), "parents")
    inner = materialize(restrict(edges, "child", parents, "parent"), "inner_edges")

    def below(nodes: DataFrame) -> DataFrame:
        return (
            nodes.join(inner, nodes["concept_id"] == inner["parent"])
            .select(F.col("child").alias("concept_id"))
            .distinct()
        )

    root = members.where(F.col("concept_id") == root_id).select("concept_id")
    reached = iterate(root, below, "levels", once=True)
    depths = reached.groupBy("concept_id").agg(F.min("step").alias("step"))
    pairs = (
        depths.join(edges, F.col("concept_id") == F.col("parent"))
        .select("parent", "child", (F.col("step") + 2).alias("depth"))
        .unionByName(
            root.select(
                F.lit(None).cast("int").alias("parent"), F.col("concept_id").alias("child"), F.lit(1).alias("depth")
            )
        )
    )
    above = members.select(F.col("concept_id").alias("parent"), F.col("concept_name").alias("parent_concept_name"))
    above = materialize(restrict(above, "parent", parents, "parent"), "parent_names")
    return (
        pairs.join(members, F.col("child") == F.col("concept_id"))
        .join(above, "parent", "left")
        .select(
            F.col("parent").alias("parent_concept_id"),
            "parent_concept_name",
            "depth",
            "concept_id",
            "concept_code",
            "concept_name",
        )
    )


_PAIR = ["ancestor_concept_id", "descendant_concept_id"]
_LEVELS = ["min_levels_of_separation", "max_levels_of_separation"]


def _no_cycle(at, label: str) -> None:
    if at is not None:
        raise ValueError(f"{label}: the hierarchy has a cycle through {at}")


def transitive_closure(levels: DataFrame) -> DataFrame:
    """Every ancestor and descendant with the fewest and the most steps between them.

    Each round doubles the length of the paths that are covered: the pairs of paths of up to n steps
    are continued by those that some path of exactly n steps joins. Such a path is missing once n
    passes the longest, so a hierarchy of depth d takes about log2(d) rounds. The rounds go over the
    concepts that have something below them; the tips, mostly the greater part, follow in one join. A
    concept that is its own ancestor is an error that names it.
    """
    one = F.lit(1)
    edges = (
        levels.where("parent_concept_id is not null")
        .select(F.col("parent_concept_id").alias("ancestor"), F.col("concept_id").alias("descendant"))
        .distinct()
    )
    edges = materialize(flag(edges, "descendant", edges, "ancestor", "goes_on"), "links")
    pairs = edges.where("goes_on").select("ancestor", "descendant", one.alias("low"), one.alias("high"), F.lit(True).alias("exact"))
    n = 1
    while True:
        loop = F.max(F.when(F.col("ancestor") == F.col("descendant"), F.col("ancestor")))
        at, more = pairs.agg(loop, F.bool_or("exact")).first()
        _no_cycle(at, "closure")
        if not more:
            break
        steps = pairs.where("exact").select(F.col("ancestor").alias("middle"), F.col("descendant").alias("end"))
        longer = pairs.join(steps, F.col("descendant") == F.col("middle")).select(
            "ancestor", F.col("end").alias("descendant"), (F.col("low") + n).alias("low"), (F.col("high") + n).alias("high"), "exact"
        )
        pairs = materialize(
            pairs.withColumn("exact", F.lit(False))
            .unionByName(longer)
            .groupBy("ancestor", "descendant")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("exact").alias("exact")),
            "closure",
        )
        n *= 2
    pairs = pairs.select("ancestor", "descendant", "low", "high")
    # A tip is below its parents and all that is above them.
    last = edges.where("not goes_on")
    over = pairs.select("ancestor", F.col("descendant").alias("middle"), "low", "high")
    tips = last.select(F.col("ancestor").alias("middle"), "descendant").join(over, "middle").select(
        "ancestor", "descendant", (F.col("low") + 1).alias("low"), (F.col("high") + 1).alias("high")
    )
    tips = (
        last.select("ancestor", "descendant", one.alias("low"), one.alias("high"))
        .unionByName(tips)
        .groupBy("ancestor", "descendant")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    return pairs.unionByName(tips).select(
        F.col("ancestor").alias(_PAIR[0]), F.col("descendant").alias(_PAIR[1]), F.col("low").alias(_LEVELS[0]), F.col("high").alias(_LEVELS[1])
    )


def _ways(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "d").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _followed(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths of ``first`` continued by those of ``second``."""
    second = second.select(F.col("a").alias("b"), F.col("d").alias("e"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    return first.join(second, F.col("d") == F.col("b")).select(
        "a", F.col("e").alias("d"), (F.col("low") + F.col("low2")).alias("low"), (F.col("high") + F.col("high2")).alias("high")
    )


def closure_delta(closure: DataFrame, added: DataFrame) -> DataFrame:
    """The rows of a closure that more edges (parent_concept_id, concept_id) create or change.

    A path that uses added edges goes down the old closure to the first of them, from each to the
    next one, and on from the last: pairs above x pairs between added edges x pairs below. Of the
    old closure only the pairs that end at an added edge are joined. A cycle is an error that names
    a concept of it.
    """
    known = closure.select(*(F.col(c).alias(n) for c, n in zip([*_PAIR, *_LEVELS], ("a", "d", "low", "high"), strict=True)))
    edges = materialize(
        added.where("parent_concept_id is not null and concept_id is not null")
        .select(F.col("parent_concept_id").alias("a"), F.col("concept_id").alias("d"), F.lit(1).alias("low"), F.lit(1).alias("high"))
        .distinct(),
        "added",
    )
    # Pairs of a node with itself are left out: they would be as many as the added edges.
    tops = materialize(edges.select("a").distinct(), "added_tops")
    inside = known.select("a").distinct().join(edges.select(F.col("d").alias("a")).distinct().hint("merge"), "a", "left_semi")
    inside = materialize(inside, "added_ends")
    above = materialize(known.join(tops.select(F.col("a").alias("d")), "d", "left_semi").select(*edges.columns), "above")
    below = materialize(known.join(inside, "a", "left_semi").select(*edges.columns), "below")
    between = materialize(below.join(tops.select(F.col("a").alias("d")), "d", "left_semi").select(*edges.columns), "between")
    self_loop = F.max(F.when(F.col("a") == F.col("d"), F.col("a")))
    paths, seen = edges, None
    while True:
        at_top = paths.join(tops.select(F.col("a").alias("d")), "d", "left_semi").select(*edges.columns)
        to_next = materialize(_ways(at_top.unionByName(_followed(paths, between))), "to_next")
        _no_cycle(union_all(paths, to_next).agg(self_loop).first()[0], "added edges")
        size = paths.agg(F.count(F.lit(1)), F.sum("low"), F.sum("high")).first()
        if size == seen:
            break
        seen = size
        paths = materialize(_ways(paths.unionByName(_followed(to_next, paths))), "added_paths")
    reaching = materialize(paths.unionByName(_followed(above, paths)), "reaching")
    found = materialize(_ways(reaching.unionByName(_followed(reaching, below))), "delta")
    _no_cycle(found.agg(self_loop).first()[0], "added edges")
    old = known.select("a", "d", F.col("low").alias("low0"), F.col("high").alias("high0"))
    # Both grow with the closure: not to be collected for a broadcast, however well they are packed.
    changed = found.join(old.hint("merge"), ["a", "d"], "left").where("low0 is null or low < low0 or high > high0")
    return changed.select(
        F.col("a").alias(_PAIR[0]), F.col("d").alias(_PAIR[1]), F.least("low", "low0").alias(_LEVELS[0]), F.greatest("high", "high0").alias(_LEVELS[1])
    )


def extended_closure(closure: DataFrame, added: DataFrame) -> DataFrame:
    """The closure after edges were added; rows that these don't change are kept as they are."""
    delta = materialize(closure_delta(closure, added), "closure_delta")
    return closure.join(delta.select(*_PAIR).hint("merge"), _PAIR, "left_anti").select(*delta.columns).unionByName(delta)


def backfill_ancestors(concept_ancestor: DataFrame, closure: DataFrame) -> DataFrame:
    """The ancestor table plus the pairs it lacks; existing rows keep their levels.

    Only the missing pairs are stored; the ancestor table itself is not copied.
    """
    pair = ["ancestor_concept_id", "descendant_concept_id"]
    missing = closure.join(concept_ancestor.select(*pair).hint("merge"), pair, "left_anti").select(*closure.columns)
    return concept_ancestor.unionByName(materialize(missing, "missing"))


def descendant_closure(edges: DataFrame, nodes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Distinct (aui, child_aui): each node itself and its descendants, with ``max_depth`` down to that level."""
    links = materialize(edges.select(F.col("parent_aui").alias("above"), F.col("aui").alias("below")), "edges")
    start = nodes.select("aui", F.col("aui").alias("child_aui")).distinct()
    if max_depth is None:
        reached = doubled(links, "descendants").select(F.col("above").alias("aui"), F.col("below").alias("child_aui"))
        return start.unionByName(reached.join(start.select("aui"), "aui", "left_semi").select(*start.columns)).distinct()

    def extend(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(links, pairs["child_aui"] == links["above"])
            .select("aui", F.col("below").alias("child_aui"))
            .distinct()
        )

    return iterate(start, extend, "descendants", max_depth, once=True).select("aui", "child_aui")


def parent_link(catalog: DataFrame, relink: DataFrame | None = None) -> DataFrame:
    """Set ``parent_id`` to the id of the concept named by ``external_parent_id``.

    Only where it is null; with ``relink`` (a column external_id) for just those concepts,
    whether or not they have a parent already.
    """
    if relink is None:
        return update_from(
            catalog, "external_parent_id", catalog, "external_id", "id", "parent_id", F.col("parent_id").isNull()
        )
    marks = relink.select("external_id").distinct()
    inside = catalog.join(marks, "external_id", "left_semi").select(*catalog.columns)
    outside = catalog.join(marks, "external_id", "left_anti").select(*catalog.columns)
    return update_from(inside, "external_parent_id", catalog, "external_id", "id", "parent_id").unionByName(outside)


def root_assign(catalog: DataFrame) -> DataFrame:
    """Set ``root_id`` from the root above each concept, only where it is null."""
    links = catalog.where("parent_id is not null").select(F.col("id").alias("child"), F.col("parent_id").alias("parent"))
    links = materialize(flag(links, "child", links, "parent", "goes_on"), "links")
    # The steps go over concepts that have something below them; the tips follow in one join.
    inner = materialize(links.where("goes_on").select("child", "parent"), "inner_links")

    def below(nodes: DataFrame) -> DataFrame:
        return nodes.join(inner, nodes["node"] == inner["parent"]).select("root", F.col("child").alias("node"))

    roots = catalog.where("is_root").select(F.col("id").alias("root"), F.col("id").alias("node"))
    reached = iterate(roots, below, "roots", once=True).select("root", "node")
    tips = links.where("not goes_on").join(reached.withColumnRenamed("node", "parent"), "parent")
    reached = reached.unionByName(tips.select("root", F.col("child").alias("node")))
    return update_from(catalog, "id", reached, "node", "root", "root_id", F.col("root_id").isNull())
