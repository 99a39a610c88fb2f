"""Row layouts of the catalog, the dataset registry and the ontology."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Type names without a session: a schema is read before one exists.
_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def _struct(**columns: str | StructType) -> StructType:
    return StructType(
        [StructField(name, kind if isinstance(kind, StructType) else _TYPES[kind]) for name, kind in columns.items()]
    )


# How a concept selects people, as columns rather than as text:
#   all            every row of the dataset
#   eq, in         field = lo, or field in (lo, hi)
#   between        lo <= field <= hi, compared as text
#   descendant_of  field is a descendant of lo in the ancestor table
#   exists, not_exists   person is, or is not, in the dataset `other`
# `value_field` and `value` add one more equality.
PREDICATE = _struct(
    dataset="string",
    kind="string",
    field="string",
    lo="string",
    hi="string",
    value_field="string",
    value="string",
    other="string",
)

CONCEPT = _struct(
    id="long",
    parent_id="long",
    root_id="long",
    external_id="string",
    external_parent_id="string",
    universal_id="string",
    is_patient_count_auto_calculated="boolean",
    is_numeric="boolean",
    is_parent="boolean",
    is_root="boolean",
    is_specializable="boolean",
    sql_set_id="int",
    sql_set_where="string",
    sql_field_numeric="string",
    ui_display_name="string",
    ui_display_text="string",
    ui_display_units="string",
    ui_display_tooltip="string",
    ui_numeric_default_text="string",
    ui_display_patient_count="long",
    add_date_time="timestamp",
    content_last_update_date_time="timestamp",
    predicate=PREDICATE,
)

SQL_SET = _struct(
    id="int",
    sql_set_from="string",
    is_encounter_based="boolean",
    is_event_based="boolean",
    sql_field_date="string",
    created="timestamp",
    created_by="string",
    updated="timestamp",
    updated_by="string",
)

ONTOLOGY = _struct(
    aui="string",
    parent_aui="string",
    min_code="string",
    max_code="string",
    code_count="long",
    ontology_type="string",
    sql_set_where="string",
    ui_display_name="string",
)


def conform(df: DataFrame, schema: StructType, **values) -> DataFrame:
    """Select ``schema``'s columns in order; ``values`` gives columns or constants.

    A column that is neither given nor present in ``df`` becomes a typed null.
    """
    unknown = set(values) - set(schema.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    out = []
    for field in schema.fields:
        if field.name in values:
            value = values[field.name]
            column = value if isinstance(value, Column) else F.lit(value)
        elif field.name in df.columns:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        out.append(column.cast(field.dataType).alias(field.name))
    return df.select(*out)


def as_catalog(df: DataFrame, **values) -> DataFrame:
    return conform(df, CONCEPT, **values)


def predicate(
    dataset: Column | str | None,
    kind: Column | str,
    field: Column | str | None = None,
    lo: Column | str | None = None,
    hi: Column | str | None = None,
    value_field: Column | str | None = None,
    value: Column | str | None = None,
    other: Column | str | None = None,
) -> Column:
    """The structured form of a concept's predicate."""

    def text(v):
        return (v if isinstance(v, Column) else F.lit(v)).cast("string")

    return F.struct(
        text(dataset).alias("dataset"),
        text(kind).alias("kind"),
        text(field).alias("field"),
        text(lo).alias("lo"),
        text(hi).alias("hi"),
        text(value_field).alias("value_field"),
        text(value).alias("value"),
        text(other).alias("other"),
    )
