"""A vocabulary's hierarchy with code ranges, and the catalogs made from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from conceptree import fixed_values as fixed
from conceptree.functions.numbering import number_rows, number_within
from conceptree.functions.tables import exclude, flag, union_all
from conceptree.functions.text import cut
from conceptree.operators.registry import fixed_rows, sql_set
from conceptree.schema import ONTOLOGY, as_catalog, conform, predicate
from conceptree.session import materialize


def vocabulary_terms(mrconso: DataFrame, vocabulary: str) -> DataFrame:
    """The terms of one source vocabulary."""
    return mrconso.where(F.col("sab") == vocabulary).select("aui", "sab", "code", "tty", "str")


def vocabulary_paths(mrhier: DataFrame, terms: DataFrame) -> DataFrame:
    """The paths of the nodes that have a term in the vocabulary."""
    return mrhier.select("aui", "ptr").join(terms.select("aui"), "aui", "left_semi")


def ontology_nodes(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """(aui, code, is_parent, name) of the nodes on either side of an edge.

    Parents lose their code, so that only the codes at the tips are counted later. A tip
    is named by the preferred term of its code, a parent by its own term.
    """
    parents = edges.select(F.col("parent_aui").alias("aui")).distinct().withColumn("above", F.lit(True))
    used = edges.select("aui").union(edges.select("parent_aui")).distinct()
    nodes = (
        terms.join(used, "aui", "left_semi")
        .groupBy("aui", "code")
        .agg(F.min("str").alias("own_name"))
        .join(parents, "aui", "left")
        .select("aui", "code", "own_name", F.col("above").isNotNull().alias("is_parent"))
    )
    preferred = (
        terms.where("tty = 'PT' and code is not null")
        .groupBy("code")
        .agg(F.min("str").alias("preferred"))
    )
    # A parent's code is not looked up; its own id as key keeps parents from gathering in one task.
    is_parent = F.col("is_parent")
    keyed = nodes.withColumn("key", F.when(is_parent, F.concat(F.lit("parent "), "aui")).otherwise(F.col("code")))
    return keyed.join(preferred.withColumnRenamed("code", "key"), "key", "left").select(
        "aui",
        F.when(~is_parent, F.col("code")).alias("code"),
        "is_parent",
        F.when(is_parent, F.col("own_name"))
        .otherwise(F.coalesce(F.nullif("preferred", F.lit("")), "own_name"))
        .alias("name"),
    )


def minmax_codes(closure: DataFrame, nodes: DataFrame) -> DataFrame:
    """First and last code and their number below each node; nodes without codes vanish."""
    codes = nodes.where("code is not null").select(F.col("aui").alias("child_aui"), "code")
    return (
        closure.join(codes, "child_aui")
        .select("aui", "code")
        .distinct()
        .groupBy("aui")
        .agg(
            F.min("code").alias("min_code"),
            F.max("code").alias("max_code"),
            F.count("code").alias("code_count"),
        )
    )


def member_intervals(closure: DataFrame, nodes: DataFrame) -> DataFrame:
    """(aui, lo, hi, code_count): the fewest code ranges that admit a node's codes and no others of ``nodes``.

    Codes are numbered in their order; a range starts where a node lacks the code before one of its
    own and ends where it lacks the next one, so that starts and ends meet by their rank.
    """
    codes = nodes.where("code is not null").select(F.col("aui").alias("child_aui"), "code")
    placed = number_rows(codes.select("code").distinct(), ["code"], "place")
    members = materialize(
        closure.join(codes, "child_aui").select("aui", "code").distinct().join(placed, "code").select("aui", "code", "place"), "members"
    )

    def borders(step: int, name: str) -> DataFrame:
        beside = members.select("aui", (F.col("place") + step).alias("place"))
        open_ = members.join(beside, ["aui", "place"], "left_anti").select("aui", F.col("code").alias(name), F.col("place").alias(f"{name}_place"))
        return number_within(open_, "aui", [f"{name}_place"])

    return (
        borders(1, "lo")
        .join(borders(-1, "hi"), ["aui", "rank"])
        .select("aui", "lo", "hi", (F.col("hi_place") - F.col("lo_place") + 1).alias("code_count"))
    )


def exact_tests(intervals: DataFrame, column: str) -> DataFrame:
    """(aui, intervals, code_count, test): one condition on ``column`` that admits a node's codes and no others."""
    each = F.concat(F.lit(f"{column} "), code_test(F.col("lo"), F.col("hi"), F.col("code_count")))
    rows = intervals.groupBy("aui").agg(
        F.array_sort(F.collect_list(F.struct("lo", each.alias("test"))))["test"].alias("tests"), F.sum("code_count").alias("code_count")
    )
    test = F.concat_ws(" OR ", "tests")
    return rows.select(
        "aui", F.size("tests").alias("intervals"), "code_count", F.when(F.size("tests") > 1, F.concat(F.lit("("), test, F.lit(")"))).otherwise(test).alias("test")
    )


def code_test(low: Column, high: Column, count: Column) -> Column:
    """`= 'A'` for one code, `IN ('A','B')` for two, `BETWEEN 'A' AND 'B'` for more."""
    return (
        F.when(count == 1, F.concat(F.lit("= '"), low, F.lit("'")))
        .when(count == 2, F.concat(F.lit("IN ('"), low, F.lit("','"), high, F.lit("')")))
        .otherwise(F.concat(F.lit("BETWEEN '"), low, F.lit("' AND '"), high, F.lit("'")))
    )


def code_range_predicate(ranges: DataFrame, nodes: DataFrame, edges: DataFrame, ontology_type: str) -> DataFrame:
    """The ontology: one row per node and parent, with its test and display name."""
    low, high, count = F.col("min_code"), F.col("max_code"), F.col("code_count")
    span = F.when(count == 1, low).otherwise(F.concat(low, F.lit("-"), high))
    rows = ranges.join(nodes.select("aui", "name").distinct(), "aui").join(edges, "aui", "left")
    return conform(
        rows,
        ONTOLOGY,
        parent_aui=F.nullif("parent_aui", F.lit("")),
        ontology_type=ontology_type,
        sql_set_where=code_test(low, high, count),
        ui_display_name=F.concat("name", F.lit(f" ({ontology_type}:"), span, F.lit(")")),
    )


def _code_predicate(dataset: str, field: str) -> Column:
    count = F.col("code_count")
    return predicate(
        dataset,
        F.when(count == 1, "eq").when(count == 2, "in").otherwise("between"),
        field,
        F.col("min_code"),
        F.col("max_code"),
    )


def ontology_to_catalog(
    ontology: DataFrame,
    existing: DataFrame,
    text_prefix: str,
    sql_set_id: int,
    predicate_prefix: str = "",
    dataset: str | None = None,
    field: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Catalog rows of an ontology, without those whose id ``existing`` has already.

    ``predicate_prefix`` goes before the code test, as in ``@.CodingSystem = 'ICD10' AND
    @.Code ``. Each parent of a node gives a row of its own.
    """
    stamp = F.current_timestamp() if as_of is None else as_of
    flagged = flag(ontology, "aui", ontology.where("parent_aui is not null"), "parent_aui", "is_parent")
    rows = as_catalog(
        flagged,
        external_id=F.concat(F.lit("UMLS_AUI:"), "aui"),
        external_parent_id=F.concat(F.lit("UMLS_AUI:"), "parent_aui"),
        is_patient_count_auto_calculated=True,
        is_numeric=False,
        is_root=F.col("parent_aui").isNull(),
        is_specializable=False,
        sql_set_id=sql_set_id,
        sql_set_where=F.concat(F.lit(predicate_prefix), "sql_set_where"),
        ui_display_text=F.concat(F.lit(text_prefix + " "), "ui_display_name"),
        add_date_time=stamp,
        content_last_update_date_time=stamp,
        predicate=_code_predicate(dataset, field),
    )
    return exclude(rows, "external_id", existing, "external_id")


def dedupe_suffix(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Make ``key`` unique: the second row of a value gets ``_2``, the third ``_3``, ...

    Where such a name is a value of its own already, all suffixes get one more underscore.
    """
    rank, suffix = F.col("_rank"), "_"
    numbered = number_within(rows, key, order, "_rank")
    while True:
        name = F.concat(key, F.lit(suffix), rank.cast("string"))
        taken = numbered.where(rank > 1).select(name.alias(key)).join(numbered.where(rank == 1).select(key), key, "left_semi")
        if taken.isEmpty():
            break
        suffix += "_"
    return numbered.select(
        *[c for c in rows.columns if c != key], F.when(rank > 1, name).otherwise(F.col(key)).alias(key)
    ).select(*rows.columns)


@dataclass(frozen=True)
class CodeCatalog:
    """What differs between the catalogs made from coded vocabularies."""

    urn: str
    dataset: str
    type_field: str
    type_value: str
    code_field: str
    text_prefix: str
    group_row: tuple | None  # catalog root, written by the first vocabulary of a dataset
    name: str
    text: str
    parent_urn: str
    top_aui: str | None = None  # if set: synthetic top row, children of this node moved to it


_DIAGNOSES = ("dx", None, False, True, True, "dbo.DIAGNOSIS", None, None,
              "Diagnoses", "Have had a diagnosis", None, None, "all")
_PROCEDURES = ("px", None, False, True, True, "dbo.PROCEDURES", None, None,
               "Procedures", "Have had a procedure", None, None, "all")

# fixed values
ICD10 = CodeCatalog(
    "dx:icd10", "dbo.DIAGNOSIS", "DX_TYPE", "10", "DX", "Had diagnosis of ", _DIAGNOSES,
    "ICD-10", "Have had a diagnosis coded in ICD-10", "dx",
)
CPT = CodeCatalog(
    "px:cpt", "dbo.PROCEDURES", "PX_TYPE", "CH", "PX", "Had the procedure ", _PROCEDURES,
    "CPT", "Have had a procedure coded in CPT", "px",
)
ICD10PCS = CodeCatalog(
    "px:icd10pcs", "dbo.PROCEDURES", "PX_TYPE", "10", "PX", "Had the procedure ", None,
    "ICD10PCS", "Have had a procedure coded in ICD10PCS", "px", top_aui=fixed.PROCEDURES_ICD10PCS_TOP_AUI,
)


def universal_id_catalog(
    ontology: DataFrame,
    registry: DataFrame,
    kind: CodeCatalog,
    top_aui: str | None = None,
    name_length: int | None = None,
) -> DataFrame:
    """Catalog rows named by their codes (``urn:...:min_max``) instead of by node.

    The vocabulary's top rows are its nodes without parent, or, with a top AUI, a synthetic
    row that takes over that node's children and any other node without parent. Names are
    kept whole unless ``name_length`` cuts them.
    """
    spark = ontology.sparkSession
    top_aui = top_aui or kind.top_aui
    prefix = f"{fixed.URN}{kind.urn}"
    low, high, count = F.col("min_code"), F.col("max_code"), F.col("code_count")
    rows = ontology.select(
        "aui",
        "parent_aui",
        F.concat(F.lit(prefix + ":"), F.when(count == 1, low).otherwise(F.concat(low, F.lit("_"), high))).alias(
            "universal_id"
        ),
        (count != 1).alias("is_parent"),
        F.concat(
            F.lit(f"@.{kind.type_field} = '{kind.type_value}' AND @.{kind.code_field} "), "sql_set_where"
        ).alias("sql_set_where"),
        "ui_display_name",
        F.concat(F.lit(kind.text_prefix), "ui_display_name").alias("ui_display_text"),
        _code_predicate(kind.dataset, kind.code_field).alias("predicate"),
    )
    rows = materialize(dedupe_suffix(rows, "universal_id", ["aui", "parent_aui"]), "universal")

    ids = rows.groupBy(F.col("aui").alias("parent_aui")).agg(F.min("universal_id").alias("external_parent_id"))
    below = rows.where("parent_aui is not null")
    if top_aui is None:
        top = rows.where("parent_aui is null").select("universal_id")
        coded = below.join(ids, "parent_aui", "left")
    else:
        top = spark.range(1).select(F.lit(prefix).alias("universal_id"))
        moved = F.col("parent_aui").isNull() | (F.col("parent_aui") == top_aui)
        below = rows.where((F.col("aui") != top_aui) | F.col("parent_aui").isNotNull())
        coded = below.join(ids, "parent_aui", "left").withColumn(
            "external_parent_id", F.when(moved, F.lit(prefix)).otherwise(F.col("external_parent_id"))
        )

    name = cut(F.col("ui_display_name"), name_length) if name_length else F.col("ui_display_name")
    set_id = sql_set(registry, kind.dataset)
    parts = [
        as_catalog(
            top,
            external_id=F.col("universal_id"),
            external_parent_id=fixed.URN + kind.parent_urn,
            is_numeric=False,
            is_parent=True,
            is_root=False,
            sql_set_id=set_id,
            ui_display_name=kind.name,
            ui_display_text=kind.text,
            predicate=predicate(kind.dataset, "all"),
        ),
        as_catalog(
            coded,
            external_id=F.col("universal_id"),
            is_numeric=False,
            is_root=False,
            sql_set_id=set_id,
            ui_display_name=name,
        ),
    ]
    if kind.group_row:
        urn = F.concat(F.lit(fixed.URN), "external_id")
        group = as_catalog(
            fixed_rows(spark, [kind.group_row]),
            external_id=urn,
            universal_id=urn,
            sql_set_id=set_id,
            predicate=predicate(kind.dataset, "all"),
        )
        parts.insert(0, group)
    return union_all(*parts)
