"""Clinical tables and vocabularies derived from the test tables.

Only casts, arithmetic, conditions and concatenation (see FIXTURES.md), so that every
operator runs on the test tables at any scale factor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from conceptree.functions.tables import union_all
from conceptree.session import materialize

ROOT = 1
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]  # 101 .. 106
GENDERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]  # 8501 .. 8504
ETHNICITIES = ["Hispanic or Latino", "Not Hispanic or Latino"]  # 8700, 8701
VISITS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]  # 9201, 9202, 9203, 9205
VITALS = {"click": 3020891, "error": 3027018, "purchase": 3024171, "signup": 3012888, "view": 3004249}
VALUES = {"A": (45001, "Alpha"), "N": (45002, "Negative"), "R": (45003, "Reactive")}


def _lookup(column: Column, mapping: dict) -> Column:
    return reduce(lambda c, kv: c.when(column == kv[0], F.lit(kv[1])), mapping.items(), F)


def _digit(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int")


class TestTables:
    """``tables["measurement"]`` and so on, over one folder of test tables."""

    __test__ = False

    # Read many times over by what is built on them: stored, as the real ones are.
    VOCABULARY = ("concept", "concept_relationship", "concept_ancestor", "mrconso", "mrhier")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.VOCABULARY:
            return getattr(self, "_" + name)()
        if name not in self._stored:
            self._stored[name] = materialize(getattr(self, "_" + name)(), name)
        return self._stored[name]

    # ------------------------------------------------------------------ people and visits
    def _person(self) -> DataFrame:
        gender = _lookup(F.col("c_mktsegment"), {g: 8501 + i for i, g in enumerate(GENDERS)}).otherwise(0)
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("person_id"),
                gender.alias("gender_concept_id"),
                (F.lit(8600) + F.col("n_regionkey")).alias("race_concept_id"),
                F.when(F.col("c_nationkey") % 5 == 4, 0)
                .otherwise(F.lit(8700) + F.col("c_nationkey") % 2)
                .alias("ethnicity_concept_id"),
                F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") * 37 % 25000).cast("int"))
                .cast("timestamp")
                .alias("birth_datetime"),
                F.col("c_nationkey").cast("long").alias("location_id"),
            )
        )

    def _location(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("long").alias("location_id"),
            F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("zip"),
            F.col("n_name").alias("state"),
        )

    def _death(self) -> DataFrame:
        day = F.date_add(F.lit("2001-08-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
        return (
            self.raw("customer")
            .where("c_acctbal < 0")
            .select(
                F.col("c_custkey").alias("person_id"),
                day.alias("death_date"),
                day.cast("timestamp").alias("death_datetime"),
                F.lit(None).cast("int").alias("death_type_concept_id"),
                F.lit(None).cast("int").alias("cause_concept_id"),
                F.lit(None).cast("string").alias("cause_source_value"),
                F.lit(None).cast("int").alias("cause_source_concept_id"),
            )
        )

    def _visit_occurrence(self) -> DataFrame:
        code = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 0).otherwise(
            F.lit(9200) + _digit(F.col("o_orderpriority"))
        )
        return self.raw("orders").select(
            F.col("o_custkey").alias("person_id"),
            code.alias("visit_concept_id"),
            F.col("o_orderdate").alias("visit_start_datetime"),
        )

    # ---------------------------------------------------------------------- measurements
    def _part_codes(self) -> DataFrame:
        tid = _lookup(F.col("p_type"), {t: 101 + i for i, t in enumerate(TYPES)})
        bn = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("int")
        return (
            self.raw("part")
            .select("p_partkey", "p_name", "p_type", "p_brand", tid.alias("tid"), bn.alias("bn"))
            .withColumn("combo", F.col("tid") * 100 + F.col("bn"))
            .withColumn("concept_id", (F.lit(1000000) + F.col("p_partkey")).cast("int"))
        )

    def _sales(self, *columns: str) -> DataFrame:
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_shipdate", *columns)
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def _lab_rows(self) -> DataFrame:
        part = self._part_codes().select("p_partkey", "tid", "bn", "combo", "concept_id")
        even = F.col("l_partkey") % 2 == 0
        value = _lookup(F.col("l_returnflag"), {f: v for f, (v, _) in VALUES.items()})
        # Parts first: a filter on the concept leaves few lines to look up orders for.
        return (
            self.raw("lineitem")
            .select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_returnflag")
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(self.raw("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("person_id"),
                F.when((F.col("tid") == 105) & (F.col("bn") == 1), F.col("combo"))
                .otherwise(F.col("concept_id"))
                .alias("measurement_concept_id"),
                F.when(even, F.col("l_quantity")).alias("value_as_number"),
                F.when(~even, value).alias("value_as_concept_id"),
                F.col("l_shipdate").alias("measurement_datetime"),
            )
        )

    def _vital_rows(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("person_id"),
            _lookup(F.col("event_type"), VITALS).alias("measurement_concept_id"),
            F.col("value").alias("value_as_number"),
            F.lit(None).cast("int").alias("value_as_concept_id"),
            F.col("ts").cast("timestamp").alias("measurement_datetime"),
        )

    def _measurement(self) -> DataFrame:
        return self._lab_rows().unionByName(self._vital_rows())

    # ------------------------------------------------------------------------ vocabulary
    def _combos(self) -> DataFrame:
        return self._part_codes().select("tid", "bn", "combo", "p_type", "p_brand").distinct()

    def _nodes(self) -> DataFrame:
        """(concept_id, code, name, partkey) of the hierarchy; partkey is null above parts."""
        spark, part = self.spark, self._part_codes()
        root = spark.range(1).select(F.lit(ROOT).alias("concept_id"), F.lit("Catalog").alias("name"))
        types = part.select(F.col("tid").alias("concept_id"), F.col("p_type").alias("name")).distinct()
        brands = part.select((F.lit(200) + F.col("bn")).alias("concept_id"), F.col("p_brand").alias("name")).distinct()
        combos = self._combos().select(
            F.col("combo").alias("concept_id"), F.concat_ws(" | ", "p_type", "p_brand").alias("name")
        )
        upper = union_all(root, types, brands, combos).select(
            "concept_id",
            F.col("concept_id").cast("string").alias("code"),
            "name",
            F.lit(None).cast("long").alias("partkey"),
        )
        key = F.col("p_partkey").cast("string")
        parts = part.select(
            "concept_id",
            F.concat_ws(
                ".",
                F.lpad(F.col("tid").cast("string"), 3, "0"),
                F.lpad(F.col("bn").cast("string"), 2, "0"),
                F.lpad(key, F.greatest(F.length(key), F.lit(7)), F.lit("0")),
            ).alias("code"),
            F.concat_ws(" | ", "p_type", "p_brand", "p_name").alias("name"),
            F.col("p_partkey").alias("partkey"),
        )
        return upper.unionByName(parts)

    def _unused(self) -> DataFrame:
        """(concept_id, parent_id, name) of tests that no measurement uses: below each combo a leaf, and a group with a leaf."""

        def below(first: int, parent: Column, word: str) -> DataFrame:
            return self._combos().select(
                (F.lit(first) + F.col("combo")).alias("concept_id"),
                parent.alias("parent_id"),
                F.concat_ws(" | ", "p_type", "p_brand", F.lit(word)).alias("name"),
            )

        combo = F.col("combo")
        return union_all(
            below(200000, combo, "unused"),
            below(300000, combo, "unused group"),
            below(400000, F.lit(300000) + combo, "unused in group"),
        )

    def _concept(self) -> DataFrame:
        unused = self._unused().select(
            "concept_id",
            F.col("name").alias("concept_name"),
            F.col("concept_id").cast("string").alias("concept_code"),
            F.lit("LOINC").alias("vocabulary_id"),
        )
        nodes =self._nodes().select(
            "concept_id",
            F.col("name").alias("concept_name"),
            F.col("code").alias("concept_code"),
            F.lit("LOINC").alias("vocabulary_id"),
        )
        races = self.raw("region").select(
            (F.lit(8600) + F.col("r_regionkey")).alias("concept_id"),
            F.col("r_name").alias("concept_name"),
            (F.lit(8600) + F.col("r_regionkey")).cast("string").alias("concept_code"),
            F.lit("Race").alias("vocabulary_id"),
        )
        listed = [
            *[(8501 + i, name, "Gender") for i, name in enumerate(GENDERS)],
            *[(8700 + i, name, "Ethnicity") for i, name in enumerate(ETHNICITIES)],
            *[(9200 + int(name[0]), name, "Visit") for name in VISITS],
            *[(concept, name, "LOINC") for name, concept in VITALS.items()],
            *[(concept, name, "SNOMED") for concept, name in VALUES.values()],
        ]
        codes = self.spark.createDataFrame(
            [(concept, name, str(concept), vocabulary) for concept, name, vocabulary in listed],
            "concept_id int, concept_name string, concept_code string, vocabulary_id string",
        )
        return union_all(nodes, unused, races, codes)

    def _concept_relationship(self) -> DataFrame:
        def edges(df: DataFrame, child: Column, parent: Column) -> DataFrame:
            return df.select(child.alias("concept_id_1"), parent.alias("concept_id_2")).distinct()

        part, combos = self._part_codes(), self._combos()
        tid, brand, combo, root = F.col("tid"), F.lit(200) + F.col("bn"), F.col("combo"), F.lit(ROOT)
        return union_all(
            edges(part, tid, root),
            edges(part, brand, root),
            edges(combos, combo, tid),
            edges(combos, combo, brand),
            edges(combos.where(tid == 104), combo, root),
            part.select(F.col("concept_id").alias("concept_id_1"), combo.alias("concept_id_2")),
            self._unused().select(F.col("concept_id").alias("concept_id_1"), F.col("parent_id").alias("concept_id_2")),
        ).withColumn("relationship_id", F.lit("Is a"))

    def _concept_ancestor(self) -> DataFrame:
        """On purpose without most of the pairs: they must be filled in."""

        def pairs(df: DataFrame, ancestor: str, level: int) -> DataFrame:
            return df.select(
                F.col(ancestor).alias("ancestor_concept_id"),
                F.col("concept_id").alias("descendant_concept_id"),
                F.lit(level).alias("min_levels_of_separation"),
                F.lit(level).alias("max_levels_of_separation"),
            )

        return pairs(self._nodes(), "concept_id", 0).unionByName(pairs(self._part_codes(), "combo", 1))

    def _mrconso(self) -> DataFrame:
        key = F.col("partkey")
        return self._nodes().select(
            F.concat(F.lit("A"), F.col("concept_id").cast("string")).alias("aui"),
            F.when(key.isNull() | (key % 5 == 0), "PARTS").otherwise("OTHER").alias("sab"),
            "code",
            F.when(key.isNull(), "HT").otherwise("PT").alias("tty"),
            F.col("name").alias("str"),
        )

    def _mrhier(self) -> DataFrame:
        def aui(node: Column) -> Column:
            return F.concat(F.lit("A"), node.cast("string"))

        def rows(df: DataFrame, node: Column, *above: Column) -> DataFrame:
            path = F.concat_ws(".", *map(aui, above)) if above else F.lit(None).cast("string")
            return df.select(aui(node).alias("aui"), path.alias("ptr"))

        part, combos, root = self._part_codes(), self._combos(), F.lit(ROOT)
        node, key = F.col("concept_id"), F.col("p_partkey")
        tid, brand, combo = F.col("tid"), F.lit(200) + F.col("bn"), F.col("combo")
        return union_all(
            rows(self.spark.range(1), root),
            rows(part.select("tid").distinct(), tid, root),
            rows(part.select("bn").distinct(), brand, root),
            rows(combos, combo, root, tid),
            rows(part, node, root, tid, combo),
            rows(part.where(key % 2 == 1), node, root, brand, combo),
            rows(part.where(tid == 104), node, root, combo),
            rows(part.where(key % 50 == 0), node, root, brand),
        )

    # --------------------------------------------------------------------------- PCORnet
    def _demographic(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("patid"),
                F.date_add(F.lit("1930-01-01").cast("date"), (key * 37 % 25000).cast("int")).alias("birth_date"),
                F.when(key % 17 == 0, "OT").when(key % 2 == 0, "F").otherwise("M").alias("sex"),
                F.when(key % 3 == 0, "Y").when(key % 3 == 1, "N").otherwise("U").alias("hispanic"),
                F.when(key % 11 == 0, "NI")
                .otherwise(F.concat(F.lit("0"), (F.col("n_regionkey") + 1).cast("string")))
                .alias("race"),
            )
        )

    def _encounter(self) -> DataFrame:
        kinds = {1: "AV", 2: "ED", 3: "EI", 5: "IP"}
        return self.raw("orders").select(
            F.col("o_custkey").alias("patid"),
            _lookup(_digit(F.col("o_orderpriority")), kinds).otherwise("OA").alias("enc_type"),
            F.col("o_orderdate").alias("admit_date"),
        )

    def _pcornet_death(self) -> DataFrame:
        return self._death().select(F.col("person_id").alias("patid"), "death_date")

    def _diagnosis(self) -> DataFrame:
        codes = self._nodes().where("partkey is not null").select("partkey", "code")
        return (
            self._sales()
            .join(codes, F.col("l_partkey") == F.col("partkey"))
            .select(
                F.col("o_custkey").alias("patid"),
                F.lit("10").alias("dx_type"),
                F.col("code").alias("dx"),
                F.col("l_shipdate").alias("dx_date"),
            )
        )
