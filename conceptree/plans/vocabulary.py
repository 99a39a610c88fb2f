"""From a source vocabulary to its ontology, and into a catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from conceptree.functions.numbering import number_rows
from conceptree.operators.hierarchy import descendant_closure, parent_link
from conceptree.operators.ontology import (
    code_range_predicate,
    minmax_codes,
    ontology_nodes,
    ontology_to_catalog,
    vocabulary_paths,
    vocabulary_terms,
)
from conceptree.operators.paths import path_decode
from conceptree.schema import CONCEPT, conform
from conceptree.session import materialize


def get_ontology(
    mrconso: DataFrame, mrhier: DataFrame, vocabulary: str, max_tokens: int | None = None, max_depth: int | None = None
) -> DataFrame:
    """The hierarchy of one vocabulary with its code ranges.

    Paths and levels are followed to their end unless ``max_tokens`` or ``max_depth`` bound them.
    """
    terms = vocabulary_terms(mrconso, vocabulary)
    edges = materialize(path_decode(vocabulary_paths(mrhier, terms), max_tokens), "edges")
    nodes = materialize(ontology_nodes(edges, terms), "nodes")
    closure = descendant_closure(edges, nodes, max_depth)
    return code_range_predicate(minmax_codes(closure, nodes), nodes, edges, vocabulary)


def insert_concepts(
    ontology: DataFrame,
    existing: DataFrame,
    text_prefix: str,
    sql_set_id: int,
    predicate_prefix: str = "",
    dataset: str | None = None,
    field: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """``existing`` plus the ontology's new concepts, with ids, each linked to its parent."""
    ontology = materialize(ontology, "ontology")
    new = ontology_to_catalog(ontology, existing, text_prefix, sql_set_id, predicate_prefix, dataset, field, as_of)
    last = existing.agg({"id": "max"}).first()[0] or 0
    numbered = number_rows(new.drop("id"), ["external_id", "external_parent_id"], start=last + 1)
    rows = materialize(existing.unionByName(conform(numbered, CONCEPT)), "catalog")
    # Also those that existed before: the ontology may know their parents by now.
    named = ontology.select(F.concat(F.lit("UMLS_AUI:"), "aui").alias("external_id"))
    return parent_link(rows, relink=named)
