"""Interval labels of a hierarchy: what lies below a node is told by numbers, not by a table of all pairs.

Each node hangs on its smallest parent, which makes the hierarchy a forest. The way down to a node is
the list of the nodes on it; sorted by these lists, each with one entry where the node is entered and one
after everything below it, all nodes stand as on a tour around the forest, so a node's part of the tour
holds just what hangs below it. The links to other parents are the exceptions: a node also gets the
parts of the nodes that it reaches over them, unless they lie in a part that it has already. The parts of
one node never overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from conceptree.functions.numbering import number_rows
from conceptree.functions.ranges import match_places
from conceptree.functions.tables import doubled, flag, union_all
from conceptree.session import materialize

_AFTER = (1 << 63) - 1  # sorts after whatever lies below


@dataclass
class IntervalLabels:
    """``places`` (node, root, at) on the tour; ``spans`` (node, a, b), each node's parts of it, ``a <= at < b``."""

    places: DataFrame
    spans: DataFrame

    def descendants(self, nodes: DataFrame | None = None) -> DataFrame:
        """(ancestor_concept_id, descendant_concept_id): all that is below each of ``nodes`` (a column node), itself included.

        Each pair comes once. Without ``nodes``, those of every node.
        """
        spans = self.spans if nodes is None else self.spans.join(nodes.select("node"), "node", "left_semi")
        points = self.places.select(F.col("node").alias("descendant_concept_id"), "at")
        return match_places(points, spans.withColumnRenamed("node", "ancestor_concept_id")).select(
            "ancestor_concept_id", "descendant_concept_id"
        )


def root_paths(edges: DataFrame) -> DataFrame:
    """(node, path): the nodes from a root down to each node, by its smallest parent.

    ``edges`` has above and below; a null above names a node only. Each round doubles the length that
    is known, so a hierarchy of depth d takes about log2(d) rounds. A cycle is an error that names a node of it.
    """
    nodes = edges.select(F.explode(F.array("above", "below")).alias("node")).where("node is not null").distinct()
    links = edges.where("above is not null and below is not null")
    parents = links.groupBy(F.col("below").alias("node")).agg(F.min("above").alias("top"))
    placed = materialize(flag(nodes.join(parents, "node", "left"), "node", links, "above", "goes_on"), "root_paths")
    # The rounds go over nodes that have something below them; the tips, mostly the greater part, follow in one join.
    rows = placed.where("goes_on").select("node", "top", F.array("node").alias("path"))
    while True:
        loop = F.max(F.when(F.array_contains("path", F.col("top")), F.col("top")))
        at, more = rows.where("top is not null").agg(loop, F.count(F.lit(1))).first()
        if at is not None:
            raise ValueError(f"labels: the hierarchy has a cycle through {at}")
        if not more:
            break
        up = rows.select(F.col("node").alias("top"), F.col("top").alias("next"), F.col("path").alias("before"))
        longer = rows.where("top is not null").join(up, "top")
        longer = longer.select("node", F.col("next").alias("top"), F.concat("before", "path").alias("path"))
        rows = materialize(rows.where("top is null").unionByName(longer), "root_paths")
    rows = rows.select("node", "path")
    tips, above = placed.where("not goes_on"), rows.select(F.col("node").alias("top"), "path")
    hung = tips.join(above, "top").select("node", F.concat("path", F.array("node")).alias("path"))
    alone = tips.where("top is null").select("node", F.array("node").alias("path"))
    return union_all(rows, hung, alone)


def interval_labels(edges: DataFrame) -> IntervalLabels:
    """Labels of the nodes of ``edges`` (above, below: long); see ``root_paths`` for nulls and cycles.

    Rows grow with the nodes and with what is reached over second parents, not with the depth.
    """
    edges = materialize(edges.select(F.col("above").cast("long"), F.col("below").cast("long")).distinct(), "edges")
    paths = materialize(root_paths(edges), "paths")
    entered = paths.select("node", "path", F.lit(True).alias("enters"))
    left = paths.select("node", F.concat("path", F.array(F.lit(_AFTER))).alias("path"), F.lit(False).alias("enters"))
    tour = materialize(number_rows(entered.unionByName(left), ["path"], "at", start=0), "tour")
    places = tour.where("enters").select("node", F.element_at("path", 1).alias("root"), "at")
    own = materialize(tour.groupBy("node").agg(F.min("at").alias("a"), F.max("at").alias("b")), "own_spans")

    hung = paths.select(F.col("node").alias("below"), F.get(F.reverse("path"), F.lit(1)).alias("parent"))
    second = edges.join(hung, "below").where("above <> parent").select("above", "below")
    # Whoever is on the way down to such a link's upper end reaches its lower end.
    hops = second.join(paths, F.col("above") == F.col("node")).select(F.explode("path").alias("above"), "below")
    hops = materialize(hops.distinct(), "hops")
    onward = doubled(hops.join(hops.select(F.col("below").alias("above")), "above", "left_semi"), "onward")
    if (at := onward.where("above = below").first()) is not None:
        raise ValueError(f"labels: the hierarchy has a cycle through {at['above']}")
    further = hops.join(onward.select(F.col("above").alias("below"), F.col("below").alias("end")), "below")
    reached = materialize(hops.unionByName(further.select("above", F.col("end").alias("below"))).distinct(), "reached")
    # A part lies in another one if some node on the way down to it has that one.
    have = union_all(reached, reached.select("above", F.col("above").alias("below"))).distinct()
    within = (
        reached.join(paths, F.col("below") == F.col("node"))
        .select("above", "below", F.explode("path").alias("via"))
        .where("via <> below")
        .join(have.withColumnRenamed("below", "via"), ["above", "via"], "left_semi")
    )
    apart = reached.join(within.select("above", "below"), ["above", "below"], "left_anti")
    parts = apart.join(own, F.col("below") == F.col("node")).select(F.col("above").alias("node"), "a", "b")
    return IntervalLabels(places, materialize(own.unionByName(parts), "spans"))
