"""The PCORnet catalog: fixed concepts and three coded vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from conceptree.functions.tables import exclude, union_all
from conceptree.operators.ontology import CPT, ICD10, ICD10PCS, universal_id_catalog
from conceptree.operators.registry import fixed_catalog
from conceptree.plans.omop import with_links
from conceptree.schema import CONCEPT
from conceptree.session import at_once, materialize


def build_catalog_pcornet(
    registry: DataFrame,
    icd10: DataFrame,
    cpt: DataFrame,
    icd10pcs: DataFrame,
    existing: DataFrame | None = None,
    icd10pcs_top: str | None = None,
    as_of=None,
) -> DataFrame:
    """``existing`` plus the concepts whose universal id it lacks, with ids, parents and roots."""
    spark = registry.sparkSession
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of)
    existing = spark.createDataFrame([], CONCEPT) if existing is None else existing
    coded = at_once(
        spark,
        lambda: universal_id_catalog(icd10, registry, ICD10),
        lambda: universal_id_catalog(cpt, registry, CPT),
        lambda: universal_id_catalog(icd10pcs, registry, ICD10PCS, icd10pcs_top),
    )
    new = union_all(fixed_catalog(spark, registry), *coded).withColumns({"add_date_time": stamp, "content_last_update_date_time": stamp})
    absent = exclude(materialize(new, "new"), "universal_id", existing, "universal_id")
    return with_links(absent, ["universal_id", "external_parent_id"], existing)
