"""The same queries as plain SQL on the raw test tables, written from the definitions.

``_TABLES`` are named subqueries, in order: the clinical tables made from the test tables,
then the stages of the catalogs. A query gets those it mentions, and theirs.
"""

from __future__ import annotations

import re

_TABLES: dict[str, str] = {}
_ORACLES: dict[str, str] = {}


def _with(body: str) -> str:
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & set(_TABLES) - needed:
            needed.add(name)
            pending.append(_TABLES[name])
    listed = ",\n".join(f"{name} AS (\n{_TABLES[name].strip()}\n)" for name in _TABLES if name in needed)
    body = body.strip()
    if listed and body.startswith("WITH "):  # a query with a subquery of its own
        return f"WITH RECURSIVE {listed},\n{body.removeprefix('WITH ')}"
    return f"WITH RECURSIVE {listed}\n{body}" if listed else body


def all_oracles() -> dict[str, str]:
    return {name: _with(body) for name, body in _ORACLES.items()}


# --------------------------------------------------------------------- clinical tables
_TABLES["parts"] = """
SELECT p_partkey, p_name, p_type, p_brand, tid, bn, tid * 100 + bn AS combo, CAST(1000000 + p_partkey AS INTEGER) AS concept_id
FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN 101 WHEN 'LARGE' THEN 102 WHEN 'MEDIUM' THEN 103
                            WHEN 'PROMO' THEN 104 WHEN 'SMALL' THEN 105 WHEN 'STANDARD' THEN 106 END AS tid,
             CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS bn FROM part)
"""
_TABLES["person"] = """
SELECT c_custkey AS person_id,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 8501 WHEN 'BUILDING' THEN 8502 WHEN 'FURNITURE' THEN 8503
                         WHEN 'MACHINERY' THEN 8504 ELSE 0 END AS gender_concept_id,
       8600 + n_regionkey AS race_concept_id,
       CASE WHEN c_nationkey % 5 = 4 THEN 0 ELSE 8700 + c_nationkey % 2 END AS ethnicity_concept_id,
       DATE '1930-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS birth_datetime,
       c_nationkey AS location_id
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
_TABLES["location"] = """
SELECT n_nationkey AS location_id, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, n_name AS state FROM nation
"""
_TABLES["death"] = """
SELECT c_custkey AS person_id, DATE '2001-08-01' + CAST(c_custkey % 365 AS INTEGER) AS death_date
FROM customer WHERE c_acctbal < 0
"""
_TABLES["visit_occurrence"] = """
SELECT o_custkey AS person_id,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 ELSE 9200 + CAST(o_orderpriority[1] AS INTEGER) END AS visit_concept_id,
       o_orderdate AS visit_start_datetime
FROM orders
"""
_TABLES["measurement"] = """
SELECT o_custkey AS person_id,
       CASE WHEN tid = 105 AND bn = 1 THEN combo ELSE concept_id END AS measurement_concept_id,
       CASE WHEN l_partkey % 2 = 0 THEN l_quantity END AS value_as_number,
       CASE WHEN l_partkey % 2 = 1 THEN CASE l_returnflag WHEN 'A' THEN 45001 WHEN 'N' THEN 45002 WHEN 'R' THEN 45003 END END
           AS value_as_concept_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN parts ON l_partkey = p_partkey
UNION ALL
SELECT user_id, CASE event_type WHEN 'click' THEN 3020891 WHEN 'error' THEN 3027018 WHEN 'purchase' THEN 3024171
                                WHEN 'signup' THEN 3012888 WHEN 'view' THEN 3004249 END, value, NULL
FROM events
"""
_TABLES["nodes"] = """
SELECT 1 AS concept_id, '1' AS code, 'Catalog' AS name, NULL AS partkey
UNION ALL SELECT DISTINCT tid, CAST(tid AS VARCHAR), p_type, CAST(NULL AS BIGINT) FROM parts
UNION ALL SELECT DISTINCT 200 + bn, CAST(200 + bn AS VARCHAR), p_brand, NULL FROM parts
UNION ALL SELECT DISTINCT combo, CAST(combo AS VARCHAR), p_type || ' | ' || p_brand, NULL FROM parts
UNION ALL SELECT concept_id,
       lpad(CAST(tid AS VARCHAR), 3, '0') || '.' || lpad(CAST(bn AS VARCHAR), 2, '0') || '.'
       || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(7, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0'),
       p_type || ' | ' || p_brand || ' | ' || p_name, p_partkey FROM parts
"""
_TABLES["unused"] = """
SELECT DISTINCT 200000 + combo AS concept_id, combo AS parent_id, p_type || ' | ' || p_brand || ' | unused' AS name FROM parts
UNION ALL SELECT DISTINCT 300000 + combo, combo, p_type || ' | ' || p_brand || ' | unused group' FROM parts
UNION ALL SELECT DISTINCT 400000 + combo, 300000 + combo, p_type || ' | ' || p_brand || ' | unused in group' FROM parts
"""
_TABLES["concept"] = """
SELECT concept_id, name AS concept_name, code AS concept_code, 'LOINC' AS vocabulary_id FROM nodes
UNION ALL SELECT concept_id, name, CAST(concept_id AS VARCHAR), 'LOINC' FROM unused
UNION ALL SELECT 8600 + r_regionkey, r_name, CAST(8600 + r_regionkey AS VARCHAR), 'Race' FROM region
UNION ALL SELECT id, name, CAST(id AS VARCHAR), vocabulary FROM (VALUES
  (8501, 'AUTOMOBILE', 'Gender'), (8502, 'BUILDING', 'Gender'), (8503, 'FURNITURE', 'Gender'), (8504, 'MACHINERY', 'Gender'),
  (8700, 'Hispanic or Latino', 'Ethnicity'), (8701, 'Not Hispanic or Latino', 'Ethnicity'),
  (9201, '1-URGENT', 'Visit'), (9202, '2-HIGH', 'Visit'), (9203, '3-MEDIUM', 'Visit'), (9205, '5-LOW', 'Visit'),
  (3020891, 'click', 'LOINC'), (3027018, 'error', 'LOINC'), (3024171, 'purchase', 'LOINC'), (3012888, 'signup', 'LOINC'),
  (3004249, 'view', 'LOINC'), (45001, 'Alpha', 'SNOMED'), (45002, 'Negative', 'SNOMED'), (45003, 'Reactive', 'SNOMED')
) AS v(id, name, vocabulary)
"""
_TABLES["concept_relationship"] = """
SELECT DISTINCT tid AS concept_id_1, 1 AS concept_id_2, 'Is a' AS relationship_id FROM parts
UNION ALL SELECT DISTINCT 200 + bn, 1, 'Is a' FROM parts
UNION ALL SELECT DISTINCT combo, tid, 'Is a' FROM parts
UNION ALL SELECT DISTINCT combo, 200 + bn, 'Is a' FROM parts
UNION ALL SELECT DISTINCT combo, 1, 'Is a' FROM parts WHERE tid = 104
UNION ALL SELECT concept_id, combo, 'Is a' FROM parts
UNION ALL SELECT concept_id, parent_id, 'Is a' FROM unused
"""
_TABLES["concept_ancestor"] = """
SELECT concept_id AS ancestor_concept_id, concept_id AS descendant_concept_id,
       0 AS min_levels_of_separation, 0 AS max_levels_of_separation FROM nodes
UNION ALL SELECT combo, concept_id, 1, 1 FROM parts
"""
_TABLES["mrconso"] = """
SELECT 'A' || concept_id AS aui, CASE WHEN partkey IS NULL OR partkey % 5 = 0 THEN 'PARTS' ELSE 'OTHER' END AS sab,
       code, CASE WHEN partkey IS NULL THEN 'HT' ELSE 'PT' END AS tty, name AS str
FROM nodes
"""
_TABLES["mrhier"] = """
SELECT 'A1' AS aui, CAST(NULL AS VARCHAR) AS ptr
UNION ALL SELECT DISTINCT 'A' || tid, 'A1' FROM parts
UNION ALL SELECT DISTINCT 'A' || (200 + bn), 'A1' FROM parts
UNION ALL SELECT DISTINCT 'A' || combo, 'A1.A' || tid FROM parts
UNION ALL SELECT 'A' || concept_id, 'A1.A' || tid || '.A' || combo FROM parts
UNION ALL SELECT 'A' || concept_id, 'A1.A' || (200 + bn) || '.A' || combo FROM parts WHERE p_partkey % 2 = 1
UNION ALL SELECT 'A' || concept_id, 'A1.A' || combo FROM parts WHERE tid = 104
UNION ALL SELECT 'A' || concept_id, 'A1.A' || (200 + bn) FROM parts WHERE p_partkey % 50 = 0
"""
_TABLES["demographic"] = """
SELECT c_custkey AS patid, DATE '1930-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS birth_date,
       CASE WHEN c_custkey % 17 = 0 THEN 'OT' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
       CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'U' END AS hispanic,
       CASE WHEN c_custkey % 11 = 0 THEN 'NI' ELSE '0' || (n_regionkey + 1) END AS race
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
_TABLES["encounter"] = """
SELECT o_custkey AS patid,
       CASE o_orderpriority[1] WHEN '1' THEN 'AV' WHEN '2' THEN 'ED' WHEN '3' THEN 'EI' WHEN '5' THEN 'IP' ELSE 'OA' END AS enc_type
FROM orders
"""
_TABLES["diagnosis"] = """
SELECT o_custkey AS patid, '10' AS dx_type, code AS dx
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN nodes ON l_partkey = partkey
"""
_TABLES["datasets"] = """
SELECT * FROM (VALUES
  (1, 'dbo.person', 0, 0, NULL), (2, 'dbo.visit_occurrence', 1, 0, '@.visit_start_datetime'),
  (3, 'dbo.condition_occurrence', 1, 0, '@.condition_start_datetime'), (4, 'dbo.v_death', 1, 0, '@.death_datetime'),
  (5, 'dbo.device_exposure', 1, 0, '@.device_exposure_start_datetime'), (6, 'dbo.drug_exposure', 1, 0, '@.drug_exposure_start_datetime'),
  (7, 'dbo.measurement', 1, 0, '@.measurement_datetime'), (8, 'dbo.observation', 1, 0, '@.observation_datetime'),
  (9, 'dbo.procedure_occurrence', 1, 0, '@.procedure_datetime')
) AS d(id, sql_set_from, is_encounter_based, is_event_based, sql_field_date)
"""

# ------------------------------------------------------------------- vocabulary to ontology
_TABLES["terms"] = "SELECT aui, sab, code, tty, str FROM mrconso WHERE sab = 'PARTS'"
_TABLES["paths"] = "SELECT aui, ptr FROM mrhier WHERE aui IN (SELECT aui FROM terms)"
_TABLES["tokens"] = """
SELECT aui, CASE instr(ptr, '.') WHEN 0 THEN ptr ELSE left(ptr, instr(ptr, '.') - 1) END AS code, '' AS before, 0 AS n,
       nullif(right(ptr, CASE instr(ptr, '.') WHEN 0 THEN length(ptr) ELSE length(ptr) - instr(ptr, '.') END), '') AS rest
FROM paths WHERE ptr IS NOT NULL
UNION ALL
SELECT aui, CASE instr(rest, '.') WHEN 0 THEN rest ELSE left(rest, instr(rest, '.') - 1) END, code, n + 1,
       nullif(right(rest, CASE instr(rest, '.') WHEN 0 THEN length(rest) ELSE length(rest) - instr(rest, '.') END), '')
FROM tokens WHERE rest IS NOT NULL AND NOT (instr(rest, '.') = 0 AND rest = code AND code = before)
"""
_TABLES["codes_found"] = "SELECT code, before, aui, min(n) AS n FROM tokens GROUP BY code, before, aui"
_TABLES["edges"] = """
SELECT before AS parent_aui, code AS aui FROM codes_found WHERE code <> before
UNION
SELECT code, aui FROM codes_found f WHERE n = (SELECT max(n) FROM codes_found g WHERE g.aui = f.aui)
"""
_TABLES["all_codes"] = """
SELECT a.aui, CASE WHEN a.aui IN (SELECT parent_aui FROM edges) THEN NULL ELSE a.code END AS code,
       CASE WHEN a.aui IN (SELECT parent_aui FROM edges) THEN 1 ELSE 0 END AS is_parent,
       CASE WHEN a.aui IN (SELECT parent_aui FROM edges) THEN a.str
            ELSE coalesce((SELECT min(p.str) FROM terms p WHERE p.tty = 'PT' AND p.code = a.code), a.str) END AS name
FROM terms a
WHERE a.aui IN (SELECT aui FROM edges) OR a.aui IN (SELECT parent_aui FROM edges)
"""
_TABLES["reach"] = """
SELECT aui, aui AS child_aui FROM all_codes
UNION
SELECT r.aui, e.aui FROM reach r JOIN edges e ON r.child_aui = e.parent_aui
"""
_TABLES["minmax"] = """
SELECT d.aui, min(c.code) AS min_code, max(c.code) AS max_code, count(DISTINCT c.code) AS code_count
FROM (SELECT DISTINCT aui, child_aui FROM reach) d JOIN all_codes c ON d.child_aui = c.aui
WHERE c.code IS NOT NULL GROUP BY d.aui
"""
_TABLES["ontology"] = """
SELECT m.aui, nullif(e.parent_aui, '') AS parent_aui, min_code, max_code, code_count, 'PARTS' AS ontology_type,
       CASE code_count WHEN 1 THEN '= ''' || min_code || ''''
                       WHEN 2 THEN 'IN (''' || min_code || ''',''' || max_code || ''')'
                       ELSE 'BETWEEN ''' || min_code || ''' AND ''' || max_code || '''' END AS sql_set_where,
       c.name || ' (PARTS:' || CASE code_count WHEN 1 THEN min_code ELSE min_code || '-' || max_code END || ')' AS ui_display_name
FROM minmax m JOIN all_codes c ON m.aui = c.aui LEFT JOIN edges e ON m.aui = e.aui
"""
_TABLES["named_ids"] = """
SELECT *, base || CASE WHEN rn > 1 THEN '_' || rn ELSE '' END AS id
FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY aui, parent_aui NULLS FIRST) AS rn
      FROM (SELECT *, CASE WHEN code_count = 1 THEN min_code ELSE min_code || '_' || max_code END AS base FROM ontology))
"""


def _coded(urn, dataset_id, type_field, type_value, field, had, group, label, text, top):
    name = "ui_display_name"
    parent = f"(SELECT min(y.id) FROM named_ids y WHERE y.aui = x.parent_aui)"
    parent_id = f"'{urn}:' || {parent}"
    if top:
        parent_id = f"CASE WHEN parent_aui IS NULL OR parent_aui = '{top}' THEN '{urn}' ELSE {parent_id} END"
        top_id, tops, rest = f"'{urn}'", "", f"parent_aui IS NOT NULL OR aui <> '{top}'"
    else:
        top_id, tops, rest = f"'{urn}:' || id", "FROM named_ids WHERE parent_aui IS NULL", "parent_aui IS NOT NULL"
    root = urn.rsplit(":", 1)[0]
    rows = []
    if group:
        rows.append(f"""SELECT '{root}' AS universal_id, '{root}' AS external_id, CAST(NULL AS VARCHAR) AS external_parent_id,
       0 AS is_numeric, 1 AS is_parent, 1 AS is_root, {dataset_id} AS sql_set_id, CAST(NULL AS VARCHAR) AS sql_set_where,
       CAST(NULL AS VARCHAR) AS sql_field_numeric, '{group[0]}' AS ui_display_name, '{group[1]}' AS ui_display_text,
       CAST(NULL AS VARCHAR) AS ui_display_units, CAST(NULL AS VARCHAR) AS ui_numeric_default_text""")
    rows.append(f"""SELECT {top_id} AS universal_id, {top_id} AS external_id, '{root}' AS external_parent_id,
       0 AS is_numeric, 1 AS is_parent, 0 AS is_root, {dataset_id} AS sql_set_id, CAST(NULL AS VARCHAR) AS sql_set_where,
       CAST(NULL AS VARCHAR) AS sql_field_numeric, '{label}' AS ui_display_name, '{text}' AS ui_display_text,
       CAST(NULL AS VARCHAR) AS ui_display_units, CAST(NULL AS VARCHAR) AS ui_numeric_default_text
{tops}""")
    rows.append(f"""SELECT '{urn}:' || id, '{urn}:' || id, {parent_id}, 0, CASE WHEN code_count = 1 THEN 0 ELSE 1 END, 0, {dataset_id},
       '@.{type_field} = ''{type_value}'' AND @.{field} ' || sql_set_where, NULL, {name}, '{had}' || ui_display_name, NULL, NULL
FROM named_ids x WHERE {rest}""")
    return "\nUNION ALL\n".join(rows)


_TABLES["cat_icd10"] = _coded(
    "urn:leaf:concept:dx:icd10", 3, "DX_TYPE", "10", "DX", "Had diagnosis of ", ("Diagnoses", "Have had a diagnosis"),
    "ICD-10", "Have had a diagnosis coded in ICD-10", None)
_TABLES["cat_cpt"] = _coded(
    "urn:leaf:concept:px:cpt", 4, "PX_TYPE", "CH", "PX", "Had the procedure ", ("Procedures", "Have had a procedure"),
    "CPT", "Have had a procedure coded in CPT", None)
_TABLES["cat_icd10pcs"] = _coded(
    "urn:leaf:concept:px:icd10pcs", 4, "PX_TYPE", "10", "PX", "Had the procedure ", None,
    "ICD10PCS", "Have had a procedure coded in ICD10PCS", "A1")

# -------------------------------------------------------------- counted OMOP concepts
_COLUMNS = """external_id, external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where,
  sql_field_numeric, ui_display_name, ui_display_text, ui_display_units, ui_numeric_default_text, ui_display_patient_count"""


def _by_code(kind):
    return f"""
SELECT 'demographics:{kind}:' || c.concept_id, 'demographics:{kind}', 0, 0, 0, 1,
       '/* ' || c.concept_name || ' */ @.{kind}_concept_id = ' || c.concept_id, NULL, c.concept_name,
       'Identify as ' || c.concept_name, NULL, NULL, count(DISTINCT person_id)
FROM person x JOIN concept c ON x.{kind}_concept_id = c.concept_id WHERE x.{kind}_concept_id <> 0
GROUP BY c.concept_name, c.concept_id"""


def _sum_of(kind):
    return f"""(SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(DISTINCT person_id) AS n FROM person x
  JOIN concept c ON x.{kind}_concept_id = c.concept_id WHERE x.{kind}_concept_id <> 0 GROUP BY c.concept_id))"""


_TABLES["cat_demographics"] = f"""
SELECT * FROM (
  SELECT 'demographics' AS external_id, CAST(NULL AS VARCHAR) AS external_parent_id, 0 AS is_numeric, 1 AS is_parent, 1 AS is_root,
         1 AS sql_set_id, CAST(NULL AS VARCHAR) AS sql_set_where, CAST(NULL AS VARCHAR) AS sql_field_numeric,
         'Demographics' AS ui_display_name, 'Have demographics' AS ui_display_text, CAST(NULL AS VARCHAR) AS ui_display_units,
         CAST(NULL AS VARCHAR) AS ui_numeric_default_text, (SELECT count(*) FROM person) AS ui_display_patient_count)
UNION ALL SELECT 'demographics:gender', 'demographics', 0, 1, 0, 1, NULL, NULL, 'Gender', 'Have gender data', NULL, NULL, {_sum_of('gender')}
UNION ALL {_by_code('gender')}
UNION ALL SELECT 'demographics:ethnicity', 'demographics', 0, 1, 0, 1, NULL, NULL, 'Ethnicity', 'Have ethnicity data', NULL, NULL, {_sum_of('ethnicity')}
UNION ALL {_by_code('ethnicity')}
UNION ALL SELECT 'demographics:race', 'demographics', 0, 1, 0, 1, NULL, NULL, 'Race', 'Have race data', NULL, NULL, {_sum_of('race')}
UNION ALL {_by_code('race')}
UNION ALL SELECT 'demographics:age', 'demographics', 1, 0, 0, 1, NULL,
  '/* Current Age */ (DATEDIFF(DAY, @.birth_datetime, GETDATE()) / 365.25)', 'Age', 'Are', 'years old', 'any current age', (SELECT count(*) FROM person)
UNION ALL SELECT 'demographics:vital', 'demographics', 0, 1, 0, 1, NULL, NULL, 'Vital Status', 'Are living or deceased', NULL, NULL,
  (SELECT count(*) FROM person)
UNION ALL SELECT 'demographics:vital:living', 'demographics:vital', 0, 0, 0, 1,
  '/* Not deceased */ NOT EXISTS (SELECT 1 FROM dbo.death AS @D WHERE @.person_id = @D.person_id)', NULL, 'Living',
  'Are living or not known to be deceased', NULL, NULL,
  (SELECT count(*) FROM person p WHERE NOT EXISTS (SELECT 1 FROM death d WHERE p.person_id = d.person_id))
UNION ALL SELECT 'demographics:vital:deceased', 'demographics:vital', 0, 0, 0, 4, NULL, NULL, 'Deceased', 'Are known to be deceased', NULL, NULL,
  (SELECT count(*) FROM person p WHERE EXISTS (SELECT 1 FROM death d WHERE p.person_id = d.person_id))
"""


def _visits(source):
    return f"""
SELECT 'visit' AS external_id, CAST(NULL AS VARCHAR) AS external_parent_id, 0 AS is_numeric, 1 AS is_parent, 1 AS is_root,
       2 AS sql_set_id, CAST(NULL AS VARCHAR) AS sql_set_where, CAST(NULL AS VARCHAR) AS sql_field_numeric,
       'Encounters' AS ui_display_name, 'Have had an encounter' AS ui_display_text, CAST(NULL AS VARCHAR) AS ui_display_units,
       CAST(NULL AS VARCHAR) AS ui_numeric_default_text,
       (SELECT count(DISTINCT person_id) FROM {source}) AS ui_display_patient_count
UNION ALL
SELECT 'visit:' || c.concept_id, 'visit', 0, 1, 0, 2, '/* ' || c.concept_name || ' */ @.visit_concept_id = ' || c.concept_id, NULL,
       c.concept_name, 'Had an ' || c.concept_name, NULL, NULL, count(DISTINCT person_id)
FROM {source} x JOIN concept c ON x.visit_concept_id = c.concept_id WHERE x.visit_concept_id <> 0
GROUP BY c.concept_name, c.concept_id
"""


_TABLES["early_visits"] = "SELECT * FROM visit_occurrence WHERE visit_start_datetime < TIMESTAMP '1998-01-01'"
_TABLES["cat_visits"] = _visits("visit_occurrence")
_TABLES["cat_early_visits"] = _visits("early_visits")
_VITALS = "(3020891, 3027018, 3024171, 3012888, 3004249, 3025315, 3036277, 40540383)"
_TABLES["cat_vitals"] = f"""
SELECT 'vitals' AS external_id, CAST(NULL AS VARCHAR) AS external_parent_id, 0 AS is_numeric, 1 AS is_parent, 1 AS is_root,
       7 AS sql_set_id, CAST(NULL AS VARCHAR) AS sql_set_where, CAST(NULL AS VARCHAR) AS sql_field_numeric,
       'Vitals' AS ui_display_name, 'Had vitals measured' AS ui_display_text, CAST(NULL AS VARCHAR) AS ui_display_units,
       CAST(NULL AS VARCHAR) AS ui_numeric_default_text,
       (SELECT count(DISTINCT person_id) FROM measurement WHERE measurement_concept_id IN {_VITALS}) AS ui_display_patient_count
UNION ALL
SELECT 'vitals:' || c.concept_id, 'vitals', 1, 0, 0, 7, '@.measurement_concept_id = ' || c.concept_id, '@.value_as_number',
       c.concept_name, 'Had ' || c.concept_name || ' measured', NULL, 'of any result', count(DISTINCT person_id)
FROM measurement x LEFT JOIN concept c ON x.measurement_concept_id = c.concept_id
WHERE x.measurement_concept_id IN {_VITALS}
GROUP BY c.concept_name, c.concept_id
"""

# ------------------------------------------------------------------------------- labs
_TABLES["walk"] = """
SELECT CAST(NULL AS INTEGER) AS parent_concept_id, concept_id, 1 AS depth
FROM concept WHERE vocabulary_id = 'LOINC' AND concept_id = 1
UNION
SELECT w.concept_id, c.concept_id, w.depth + 1
FROM walk w JOIN concept_relationship r ON w.concept_id = r.concept_id_2 JOIN concept c ON r.concept_id_1 = c.concept_id
WHERE c.vocabulary_id = 'LOINC' AND r.relationship_id = 'Is a' AND c.concept_id <> w.concept_id
"""
_TABLES["levels"] = """
SELECT w.parent_concept_id, p.concept_name AS parent_concept_name, min(depth) AS depth, w.concept_id, c.concept_code, c.concept_name
FROM walk w JOIN concept c ON w.concept_id = c.concept_id LEFT JOIN concept p ON w.parent_concept_id = p.concept_id
GROUP BY ALL
"""
_TABLES["steps"] = """
SELECT parent_concept_id AS ancestor, concept_id AS descendant, 1 AS n FROM levels WHERE parent_concept_id IS NOT NULL
UNION
SELECT s.ancestor, l.concept_id, s.n + 1 FROM steps s JOIN levels l ON s.descendant = l.parent_concept_id
"""
_TABLES["closure"] = """
SELECT ancestor AS ancestor_concept_id, descendant AS descendant_concept_id,
       min(n) AS min_levels_of_separation, max(n) AS max_levels_of_separation
FROM steps GROUP BY ancestor, descendant
"""
_TABLES["ancestors"] = """
SELECT * FROM concept_ancestor
UNION ALL
SELECT * FROM closure c WHERE NOT EXISTS (SELECT 1 FROM concept_ancestor a
  WHERE a.ancestor_concept_id = c.ancestor_concept_id AND a.descendant_concept_id = c.descendant_concept_id)
"""
_TABLES["candidates"] = """
SELECT DISTINCT 'lab:' || x.concept_id AS external_id, 'lab:' || x.parent_concept_id AS external_parent_id, 0 AS is_numeric,
       CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.parent_concept_id = x.concept_id) THEN 1 ELSE 0 END AS is_parent,
       CASE WHEN x.parent_concept_id IS NULL THEN 1 ELSE 0 END AS is_root, 7 AS sql_set_id,
       '/* ' || regexp_replace(regexp_replace(x.concept_name, 'WITH', '', 'gi'), 'SET', '', 'gi') || ' */ ' ||
       CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.parent_concept_id = x.concept_id)
            THEN 'EXISTS (SELECT 1          FROM dbo.concept_ancestor AS @CA          WHERE @CA.descendant_concept_id = @.measurement_concept_id                AND @CA.ancestor_concept_id = '
                 || x.concept_id || ')'
            ELSE '@.measurement_concept_id = ' || x.concept_id END AS sql_set_where,
       CAST(NULL AS VARCHAR) AS sql_field_numeric, x.concept_name AS ui_display_name,
       'Had laboratory test for ' || x.concept_name AS ui_display_text, CAST(NULL AS VARCHAR) AS ui_display_units,
       CAST(NULL AS VARCHAR) AS ui_numeric_default_text, 0 AS ui_display_patient_count,
       x.concept_id, x.concept_name, x.parent_concept_id
FROM levels x
"""
_TABLES["measured_leaves"] = """
SELECT * FROM candidates x
WHERE is_parent = 1 OR EXISTS (SELECT 1 FROM measurement m WHERE m.measurement_concept_id = x.concept_id)
"""
_TABLES["with_data"] = """
SELECT * FROM measured_leaves x
WHERE is_parent = 0 OR concept_id IN (SELECT a.ancestor_concept_id FROM ancestors a
  JOIN (SELECT DISTINCT measurement_concept_id FROM measurement) m ON a.descendant_concept_id = m.measurement_concept_id)
"""
_TABLES["pruned"] = """
SELECT * FROM with_data x
WHERE is_parent = 0 OR EXISTS (SELECT 1 FROM with_data y WHERE y.parent_concept_id = x.concept_id)
"""
_TABLES["counted"] = """
SELECT external_id, external_parent_id,
       CASE WHEN is_parent = 0 AND EXISTS (SELECT 1 FROM measurement m
           WHERE m.measurement_concept_id = x.concept_id AND m.value_as_number IS NOT NULL) THEN 1 ELSE 0 END AS is_numeric,
       is_parent, is_root, sql_set_id, sql_set_where, sql_field_numeric, ui_display_name, ui_display_text, ui_display_units,
       ui_numeric_default_text, coalesce(CASE WHEN is_parent = 0 THEN o.n ELSE b.n END, 0) AS ui_display_patient_count,
       concept_id, concept_name, parent_concept_id
FROM pruned x
LEFT JOIN (SELECT measurement_concept_id AS code, count(DISTINCT person_id) AS n FROM measurement GROUP BY 1) o ON o.code = x.concept_id
LEFT JOIN (SELECT a.ancestor_concept_id AS code, count(DISTINCT m.person_id) AS n
           FROM ancestors a JOIN measurement m ON a.descendant_concept_id = m.measurement_concept_id GROUP BY 1) b ON b.code = x.concept_id
"""
_TABLES["single"] = """
SELECT * FROM counted x
WHERE parent_concept_id IS NULL OR parent_concept_id = (
  SELECT y.parent_concept_id FROM counted y LEFT JOIN (SELECT concept_id, max(ui_display_patient_count) AS n FROM counted GROUP BY 1) p
    ON p.concept_id = y.parent_concept_id
  WHERE y.concept_id = x.concept_id ORDER BY p.n DESC NULLS LAST, y.parent_concept_id LIMIT 1)
"""
_TABLES["texts"] = """
SELECT external_id, external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where,
       CASE WHEN is_numeric = 1 THEN '@.value_as_number' END AS sql_field_numeric,
       CASE WHEN is_root = 1 THEN 'Labs' ELSE ui_display_name END AS ui_display_name,
       CASE WHEN is_root = 1 THEN 'Had a laboratory test performed' ELSE ui_display_text END AS ui_display_text,
       ui_display_units, CASE WHEN is_numeric = 1 THEN 'of any result' END AS ui_numeric_default_text,
       ui_display_patient_count, concept_id, concept_name
FROM single
"""
_TABLES["names1"] = """
SELECT c.external_id AS id, CASE WHEN p.external_id IS NULL THEN c.ui_display_name
       ELSE trim(replace(c.ui_display_name, p.ui_display_name, '')) END AS name
FROM texts c LEFT JOIN texts p ON c.external_parent_id = p.external_id
"""
_TABLES["names2"] = "SELECT id, CASE WHEN left(name, 2) = '| ' THEN trim(substr(name, 3)) ELSE name END AS name FROM names1"
_TABLES["names3"] = "SELECT id, CASE WHEN left(name, 1) IN ('.', '/') THEN trim(substr(name, 2)) ELSE name END AS name FROM names2"
_TABLES["names4"] = "SELECT id, upper(left(name, 1)) || substr(name, 2) AS name FROM names3"
_TABLES["names5"] = """
SELECT id, CASE WHEN name ILIKE '%XXX%' THEN trim(regexp_replace(name, 'XXX \\|', '', 'gi')) ELSE name END AS name FROM names4
"""
_TABLES["cleaned"] = """
SELECT external_id, external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where, sql_field_numeric,
       n.name AS ui_display_name, ui_display_text, ui_display_units, ui_numeric_default_text, ui_display_patient_count,
       concept_id, concept_name
FROM texts t JOIN names5 n ON n.id = t.external_id
"""
_TABLES["results"] = """
SELECT x.concept_id, m.value_as_concept_id AS value_id, c.concept_name AS value_name, count(DISTINCT m.person_id) AS n
FROM cleaned x JOIN measurement m ON x.concept_id = m.measurement_concept_id JOIN concept c ON c.concept_id = m.value_as_concept_id
WHERE x.is_parent = 0 GROUP BY 1, 2, 3
"""
_TABLES["cat_labs"] = f"""
SELECT external_id, external_parent_id, is_numeric,
       CASE WHEN EXISTS (SELECT 1 FROM results y WHERE y.concept_id = x.concept_id) THEN 1 ELSE is_parent END AS is_parent,
       is_root, sql_set_id, sql_set_where, sql_field_numeric, ui_display_name, ui_display_text, ui_display_units,
       ui_numeric_default_text, ui_display_patient_count
FROM cleaned x
UNION ALL
SELECT x.external_id || ':' || y.value_id, x.external_id, x.is_numeric, 0, x.is_root, x.sql_set_id,
       x.sql_set_where || ' AND @.value_as_concept_id = ' || y.value_id, x.sql_field_numeric, y.value_name,
       x.ui_display_text || ' that was ' || y.value_name, x.ui_display_units, x.ui_numeric_default_text, y.n
FROM results y JOIN cleaned x ON y.concept_id = x.concept_id
"""

# ------------------------------------------------------------------------ whole catalogs
_TABLES["cat_omop"] = """
SELECT * FROM cat_demographics UNION ALL SELECT * FROM cat_visits UNION ALL SELECT * FROM cat_vitals UNION ALL SELECT * FROM cat_labs
"""
_PCORNET_ROWS = """
  ('demographic', NULL, 0, 1, 1, 1, NULL, NULL, 'Demographics', 'Have demographics', NULL, NULL),
  ('demographic:sex', 'demographic', 0, 1, 0, 1, NULL, NULL, 'Sex', 'Identify with a sex', NULL, NULL),
  ('demographic:sex:F', 'demographic:sex', 0, 0, 0, 1, '@.SEX = ''F''', NULL, 'Female', 'Were female at birth', NULL, NULL),
  ('demographic:sex:M', 'demographic:sex', 0, 0, 0, 1, '@.SEX = ''M''', NULL, 'Male', 'Were male at birth', NULL, NULL),
  ('demographic:ethnicity', 'demographic', 0, 1, 0, 1, NULL, NULL, 'Ethnicity', 'Have ethnicity data', NULL, NULL),
  ('demographic:ethnicity:Y', 'demographic:ethnicity', 0, 0, 0, 1, '@.HISPANIC = ''Y''', NULL, 'Hispanic', 'Identify as Hispanic', NULL, NULL),
  ('demographic:ethnicity:N', 'demographic:ethnicity', 0, 0, 0, 1, '@.HISPANIC = ''N''', NULL, 'Not Hispanic', 'Identify as non-Hispanic', NULL, NULL),
  ('demographic:ethnicity:U', 'demographic:ethnicity', 0, 0, 0, 1, '@.HISPANIC = ''U''', NULL, 'Unknown', 'Hispanic idenfication is Unknown', NULL, NULL),
  ('demographic:race', 'demographic', 0, 1, 0, 1, NULL, NULL, 'Race', 'Identify as one or more races', NULL, NULL),
  ('demographic:race:01', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''01''', NULL, 'American Indian or Alaska Native', 'Identify as American Indian or Alaska Native', NULL, NULL),
  ('demographic:race:02', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''02''', NULL, 'Asian', 'Identify as Asian', NULL, NULL),
  ('demographic:race:03', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''03''', NULL, 'Black or African American', 'Identify as Black or African American', NULL, NULL),
  ('demographic:race:04', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''04''', NULL, 'Native Hawaiian or Pacific Islander', 'Identify as Native Hawaiian or Pacific Islander', NULL, NULL),
  ('demographic:race:05', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''05''', NULL, 'White', 'Identify as White', NULL, NULL),
  ('demographic:race:06', 'demographic:race', 0, 0, 0, 1, '@.RACE = ''06''', NULL, 'Multiple races', 'Identify as multiple races', NULL, NULL),
  ('demographic:age', 'demographic', 1, 0, 0, 1, NULL, '/* Current Age */ (DATEDIFF(DAY, @.BIRTH_DATE, GETDATE()) / 365.25)', 'Age', 'Are', 'years old', 'any current age'),
  ('demographic:vital', 'demographic', 0, 1, 0, 1, NULL, NULL, 'Vital Status', 'Have a vital status', NULL, NULL),
  ('demographic:vital:L', 'demographic:vital', 0, 0, 0, 1, 'NOT EXISTS (SELECT 1 FROM dbo.DEATH AS @D WHERE @.PATID = @D.PATID)', NULL, 'Living', 'Patients are living', NULL, NULL),
  ('demographic:vital:D', 'demographic:vital', 0, 0, 0, 1, 'EXISTS (SELECT 1 FROM dbo.DEATH AS @D WHERE @.PATID = @D.PATID)', NULL, 'Deceased', 'Patients are deceased', NULL, NULL),
  ('encounter', NULL, 0, 1, 1, 2, NULL, NULL, 'Encounters', 'Have had an encounter', NULL, NULL),
  ('encounter:AV', 'encounter', 0, 0, 0, 2, '@.ENC_TYPE = ''AV''', NULL, 'Outpatient', 'Had an Outpatient visit', NULL, NULL),
  ('encounter:ED', 'encounter', 0, 0, 0, 2, '@.ENC_TYPE = ''ED''', NULL, 'Emergency', 'Visited the Emergency department', NULL, NULL),
  ('encounter:EI', 'encounter', 0, 0, 0, 2, '@.ENC_TYPE = ''EI''', NULL, 'Emergency/Inpatient', 'Visited the Emergency department and admitted as Inpatient', NULL, NULL),
  ('encounter:IP', 'encounter', 0, 0, 0, 2, '@.ENC_TYPE = ''IP''', NULL, 'Inpatient', 'Admitted as an Inpatient', NULL, NULL)
"""
_NAMED = """universal_id, external_id, external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where,
  sql_field_numeric, ui_display_name, ui_display_text, ui_display_units, ui_numeric_default_text"""
_TABLES["cat_fixed"] = f"""
SELECT 'urn:leaf:concept:' || external_id AS universal_id, 'urn:leaf:concept:' || external_id AS external_id,
       'urn:leaf:concept:' || external_parent_id AS external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where,
       sql_field_numeric, ui_display_name, ui_display_text, ui_display_units, ui_numeric_default_text
FROM (VALUES {_PCORNET_ROWS}) AS r(external_id, external_parent_id, is_numeric, is_parent, is_root, sql_set_id, sql_set_where,
       sql_field_numeric, ui_display_name, ui_display_text, ui_display_units, ui_numeric_default_text)
"""
_TABLES["cat_pcornet"] = """
SELECT * FROM cat_fixed UNION ALL SELECT * FROM cat_icd10 UNION ALL SELECT * FROM cat_cpt UNION ALL SELECT * FROM cat_icd10pcs
"""


def _rooted(catalog):
    """Roots by walking down from the root rows, as ids stand for external ids one to one."""
    return f"""
SELECT external_id, external_id AS root FROM {catalog} WHERE is_root = 1
UNION
SELECT c.external_id, w.root FROM rooted_{catalog} w JOIN {catalog} c ON c.external_parent_id = w.external_id
"""


for _name in ("cat_omop", "cat_pcornet"):
    _TABLES[f"rooted_{_name}"] = _rooted(_name)

# ================================================================================ queries
_ORACLES["scan_filter"] = "SELECT aui, sab, code, tty, str FROM terms"
_ORACLES["semi_join_restrict"] = "SELECT aui, ptr FROM paths"
_ORACLES["stored_vocabulary_paths"] = "SELECT aui, ptr FROM paths"
_ORACLES["stored_vocabulary_terms"] = """
SELECT aui, sab, code, tty, str FROM mrconso WHERE sab IN (SELECT sab FROM mrconso WHERE tty = 'HT')
"""
_ORACLES["values_source"] = """
SELECT enc_type, ui_display_name, count(*) AS encounters, count(DISTINCT patid) AS patients
FROM encounter JOIN (VALUES ('AV', 'Outpatient'), ('ED', 'Emergency'), ('EI', 'Emergency/Inpatient'), ('IP', 'Inpatient'))
  AS v(kind, ui_display_name) ON kind = enc_type
GROUP BY 1, 2
"""
_ORACLES["compat_view_null_column"] = """
SELECT person_id, strftime(death_date, '%Y-%m-%d') AS death_date, strftime(death_date, '%Y-%m-%d 00:00:00') AS death_datetime,
       CAST(NULL AS BIGINT) AS visit_occurrence_id
FROM death
"""
_ORACLES["upsert_append_absent"] = f"""
SELECT {_COLUMNS} FROM cat_early_visits
UNION ALL
SELECT {_COLUMNS} FROM (SELECT * FROM cat_visits UNION ALL SELECT * FROM cat_vitals) n
WHERE NOT EXISTS (SELECT 1 FROM cat_early_visits e WHERE e.external_id = n.external_id)
"""
_ORACLES["update_from_join"] = """
SELECT patid, strftime(birth_date, '%Y-%m-%d') AS birth_date, strftime(min(death_date), '%Y-%m-%d') AS died
FROM demographic LEFT JOIN death ON patid = person_id GROUP BY patid, birth_date
"""
_ORACLES["stored_replace_append"] = f"SELECT {_COLUMNS} FROM cat_visits UNION ALL SELECT {_COLUMNS} FROM cat_vitals"
_ORACLES["stored_update"] = _ORACLES["update_from_join"]
_ORACLES["path_decode"] = "SELECT parent_aui, aui FROM edges"
_ORACLES["distinct_edges"] = "SELECT DISTINCT parent_aui FROM edges WHERE parent_aui <> ''"
_ORACLES["case_searched"] = """
SELECT measurement_concept_id, CASE WHEN value_as_number IS NOT NULL THEN 'number'
       WHEN value_as_concept_id IS NOT NULL THEN 'coded' ELSE 'none' END AS result, count(*) AS measurements
FROM measurement GROUP BY 1, 2
"""
_RACE = """CASE race WHEN '05' THEN 'White' WHEN '03' THEN 'Black or African American' WHEN '02' THEN 'Asian'
  WHEN '04' THEN 'Native Hawaiian or Other Pacific Islander' WHEN '01' THEN 'American Indian or Alaska Native'
  WHEN '06' THEN 'Multi-racial' WHEN 'NI' THEN 'Unknown' WHEN 'UN' THEN 'Unknown' ELSE 'Other' END"""
_ORACLES["case_simple_recode"] = f"SELECT {_RACE} AS race_name, count(*) AS patients FROM demographic GROUP BY 1"
_BIRTH = "strftime(birth_datetime, '%Y-%m-%d 00:00:00') AS birth_datetime"
_ORACLES["semi_join_exists"] = f"""
SELECT person_id, {_BIRTH} FROM person p WHERE EXISTS (SELECT 1 FROM death d WHERE d.person_id = p.person_id)
"""
_ORACLES["anti_join_not_exists"] = f"""
SELECT person_id, {_BIRTH} FROM person p WHERE NOT EXISTS (SELECT 1 FROM death d WHERE d.person_id = p.person_id)
"""
_ORACLES["exists_flag"] = """
SELECT measurement_concept_id, max(CASE WHEN value_as_number IS NULL THEN 0 ELSE 1 END) AS has_number FROM measurement GROUP BY 1
"""
_ORACLES["scalar_subquery_count"] = """
SELECT visit_concept_id, count(*) AS visits, (SELECT count(*) FROM person) AS persons FROM visit_occurrence GROUP BY 1
"""
_ORACLES["correlated_top1_lookup"] = """
SELECT concept_id, concept_name, 'lab:' || (SELECT concept_id_2 FROM concept_relationship r WHERE r.concept_id_1 = c.concept_id
  ORDER BY concept_id_2 LIMIT 1) AS external_parent_id
FROM concept c
"""
_ORACLES["max_per_group_filter"] = """
SELECT person_id, visit_concept_id, strftime(visit_start_datetime, '%Y-%m-%d %H:%M:%S') AS visit_start_datetime
FROM visit_occurrence v
WHERE visit_start_datetime = (SELECT max(visit_start_datetime) FROM visit_occurrence w WHERE w.person_id = v.person_id)
"""
_ORACLES["inner_join_dimension"] = """
SELECT concept_id, concept_name, count(*) AS visits FROM visit_occurrence JOIN concept ON visit_concept_id = concept_id GROUP BY 1, 2
"""
_ORACLES["left_join_dimension"] = """
SELECT person_id, gender_concept_id, concept_name AS gender FROM person LEFT JOIN concept ON gender_concept_id = concept_id
"""
_ORACLES["join_equi_residual"] = """
SELECT r.concept_id_1 AS child, r.concept_id_2 AS parent, f.first_parent FROM concept_relationship r
JOIN (SELECT concept_id_1, min(concept_id_2) AS first_parent FROM concept_relationship GROUP BY 1) f
  ON f.concept_id_1 = r.concept_id_1 AND f.first_parent <> r.concept_id_2
"""
_ORACLES["range_join_codes"] = """
SELECT m.aui, count(*) AS diagnoses, count(DISTINCT patid) AS patients
FROM minmax m JOIN diagnosis ON dx BETWEEN min_code AND max_code GROUP BY m.aui
"""
_ORACLES["count_distinct_grouped"] = """
SELECT measurement_concept_id, count(DISTINCT person_id) AS patients FROM measurement GROUP BY 1
"""
_ORACLES["count_distinct_filtered"] = f"""
SELECT count(DISTINCT person_id) AS patients,
       count(DISTINCT CASE WHEN value_as_number IS NOT NULL THEN person_id END) AS with_number,
       count(DISTINCT CASE WHEN value_as_concept_id IS NOT NULL THEN person_id END) AS with_code,
       count(DISTINCT CASE WHEN measurement_concept_id IN {_VITALS} THEN person_id END) AS with_vital
FROM measurement
"""
_ORACLES["sum_of_counts"] = """
SELECT count(*) AS genders, CAST(sum(n) AS BIGINT) AS patients
FROM (SELECT count(DISTINCT person_id) AS n FROM person WHERE gender_concept_id <> 0 GROUP BY gender_concept_id)
"""
_ORACLES["having_duplicates"] = """
SELECT concept_id_1 AS concept_id, count(*) AS parents FROM concept_relationship GROUP BY 1 HAVING count(*) > 1
"""
_ORACLES["argmax_per_group"] = """
SELECT child, parent, children FROM (
  SELECT r.concept_id_1 AS child, r.concept_id_2 AS parent, s.children,
         row_number() OVER (PARTITION BY r.concept_id_1 ORDER BY s.children DESC, r.concept_id_2) AS rn
  FROM concept_relationship r JOIN (SELECT concept_id_2, count(*) AS children FROM concept_relationship GROUP BY 1) s
    ON s.concept_id_2 = r.concept_id_2)
WHERE rn = 1
"""
_ORACLES["dedupe_suffix"] = """
SELECT aui, str || CASE WHEN rn > 1 THEN '_' || rn ELSE '' END AS name
FROM (SELECT aui, str, row_number() OVER (PARTITION BY str ORDER BY aui) AS rn FROM mrconso)
"""
_ORACLES["union_distinct"] = """
SELECT concept_id_1 AS concept_id FROM concept_relationship UNION SELECT concept_id_2 FROM concept_relationship
"""
_ORACLES["union_all_catalog"] = f"""
SELECT {_COLUMNS} FROM cat_demographics UNION ALL SELECT {_COLUMNS} FROM cat_visits UNION ALL SELECT {_COLUMNS} FROM cat_vitals
"""
_ORACLES["string_functions"] = """
SELECT concept_id, left(concept_name, 5) AS cut, substr(concept_name, 4) AS rest, trim(replace(concept_name, 'Brand#', ' ')) AS replaced,
       upper(left(concept_name, 1)) || substr(concept_name, 2) AS upper_first,
       regexp_replace(concept_name, 'small', '', 'gi') AS without,
       CASE WHEN concept_name ILIKE '%ring%' THEN 1 ELSE 0 END AS has_ring, nullif(left(concept_name, 1), 'E') AS initial
FROM concept
"""
_ORACLES["concat_null_propagation"] = """
SELECT 'lab:' || measurement_concept_id || ':' || value_as_concept_id AS external_id, count(*) AS measurements FROM measurement GROUP BY 1
"""
_ORACLES["cast_and_typed_null"] = """
SELECT CAST(person_id AS VARCHAR) AS person, CAST(year(birth_datetime) AS INTEGER) AS birth_year,
       CASE WHEN gender_concept_id <> 0 THEN 1 ELSE 0 END AS has_gender, CAST(NULL AS VARCHAR) AS religion
FROM person
"""
_ORACLES["age_numeric"] = """
SELECT person_id, CAST(date_diff('day', birth_datetime, DATE '2024-01-01') AS DOUBLE) / CAST(365.25 AS DOUBLE) AS age FROM person
"""
_ORACLES["ontology_nodes"] = "SELECT aui, code, is_parent, name FROM all_codes"
_ORACLES["descendant_closure"] = "SELECT DISTINCT aui, child_aui FROM reach"
_ORACLES["minmax_codes"] = "SELECT aui, min_code, max_code, code_count FROM minmax"
_TABLES["members"] = """
SELECT DISTINCT r.aui, c.code, p.place FROM reach r JOIN all_codes c ON r.child_aui = c.aui
JOIN (SELECT code, row_number() OVER (ORDER BY code) AS place FROM (SELECT DISTINCT code FROM all_codes WHERE code IS NOT NULL)) p ON p.code = c.code
"""
_TABLES["islands"] = """
SELECT aui, min(code) AS lo, max(code) AS hi, count(*) AS n
FROM (SELECT *, place - row_number() OVER (PARTITION BY aui ORDER BY place) AS island FROM members) GROUP BY aui, island
"""
_ORACLES["exact_members"] = """
SELECT t.*, CAST((SELECT count(DISTINCT code) FROM all_codes c WHERE c.code BETWEEN r.lo AND r.hi) - code_count AS BIGINT) AS besides
FROM (
  SELECT aui, CAST(count(*) AS INTEGER) AS intervals, CAST(sum(n) AS BIGINT) AS code_count,
         CASE WHEN count(*) > 1 THEN '(' ELSE '' END || string_agg('@.DX ' || CASE n WHEN 1 THEN '= ''' || lo || ''''
             WHEN 2 THEN 'IN (''' || lo || ''',''' || hi || ''')' ELSE 'BETWEEN ''' || lo || ''' AND ''' || hi || '''' END, ' OR ' ORDER BY lo)
             || CASE WHEN count(*) > 1 THEN ')' ELSE '' END AS test
  FROM islands GROUP BY aui) t
JOIN (SELECT aui, min(lo) AS lo, max(hi) AS hi FROM islands GROUP BY aui) r ON r.aui = t.aui
"""
_ORACLES["exact_member_counts"] = """
SELECT m.aui, count(DISTINCT d.patid) AS patient_count FROM members m JOIN diagnosis d ON d.dx = m.code WHERE d.dx_type = '10' GROUP BY m.aui
"""
_ORACLES["code_range_predicate"] = """
SELECT aui, parent_aui, min_code, max_code, code_count, ontology_type, sql_set_where, ui_display_name FROM ontology
"""
_ORACLES["ontology_to_catalog"] = """
SELECT 'UMLS_AUI:' || o.aui AS external_id, 'UMLS_AUI:' || o.parent_aui AS external_parent_id,
       CASE WHEN top THEN CASE WHEN o.aui IN (SELECT aui FROM ontology) AND EXISTS (SELECT 1 FROM ontology c WHERE c.parent_aui = o.aui
                  AND (c.parent_aui = 'A1')) THEN 1 ELSE 0 END
            ELSE CASE WHEN EXISTS (SELECT 1 FROM ontology c WHERE c.parent_aui = o.aui) THEN 1 ELSE 0 END END AS is_parent,
       CASE WHEN o.parent_aui IS NULL THEN 1 ELSE 0 END AS is_root, 3 AS sql_set_id,
       CASE WHEN top THEN '' ELSE '@.DX_TYPE = ''10'' AND @.DX ' END || sql_set_where AS sql_set_where, ui_display_name,
       CASE WHEN top THEN 'Had ' ELSE 'Had diagnosis of ' END || ui_display_name AS ui_display_text,
       'UMLS_AUI:' || o.parent_aui AS parent
FROM (SELECT *, parent_aui IS NULL OR parent_aui = 'A1' AS top FROM ontology) o
WHERE top OR o.aui NOT IN (SELECT aui FROM ontology WHERE parent_aui IS NULL OR parent_aui = 'A1')
"""
_ORACLES["universal_id_catalog"] = f"SELECT {_NAMED} FROM cat_icd10"
_ORACLES["universal_id_catalog_cpt"] = f"SELECT {_NAMED} FROM cat_cpt"
_ORACLES["universal_id_catalog_icd10pcs"] = f"SELECT {_NAMED} FROM cat_icd10pcs"
_ORACLES["fixed_catalog"] = f"""
SELECT {_NAMED}, CASE
  WHEN universal_id LIKE '%:sex:%' THEN (SELECT count(DISTINCT patid) FROM demographic WHERE sex = split_part(universal_id, ':', 6))
  WHEN universal_id LIKE '%:ethnicity:%' THEN (SELECT count(DISTINCT patid) FROM demographic WHERE hispanic = split_part(universal_id, ':', 6))
  WHEN universal_id LIKE '%:race:%' THEN (SELECT count(DISTINCT patid) FROM demographic WHERE race = split_part(universal_id, ':', 6))
  WHEN universal_id LIKE '%:vital:L' THEN (SELECT count(DISTINCT patid) FROM demographic WHERE patid NOT IN (SELECT person_id FROM death))
  WHEN universal_id LIKE '%:vital:D' THEN (SELECT count(DISTINCT patid) FROM demographic WHERE patid IN (SELECT person_id FROM death))
  WHEN universal_id LIKE '%:encounter:%' THEN (SELECT count(DISTINCT patid) FROM encounter WHERE enc_type = split_part(universal_id, ':', 5))
  WHEN universal_id LIKE '%:encounter' THEN (SELECT count(DISTINCT patid) FROM encounter)
  ELSE (SELECT count(DISTINCT patid) FROM demographic) END AS patient_count
FROM cat_fixed
"""
_ORACLES["dataset_registry"] = """
SELECT id, sql_set_from, is_encounter_based, is_event_based, sql_field_date,
       (SELECT count(*) FROM (SELECT * FROM cat_demographics UNION ALL SELECT * FROM cat_visits UNION ALL SELECT * FROM cat_vitals) c
        WHERE c.sql_set_id = datasets.id) AS concepts
FROM datasets
"""
_ORACLES["demographic_concepts"] = f"SELECT {_COLUMNS} FROM cat_demographics"
_ORACLES["visit_concepts"] = f"SELECT {_COLUMNS} FROM cat_visits"
_ORACLES["vital_concepts"] = f"SELECT {_COLUMNS} FROM cat_vitals"
_ORACLES["hierarchy_levels"] = """
SELECT CAST(parent_concept_id AS VARCHAR) AS parent_concept_id, parent_concept_name, depth, concept_id, concept_code, concept_name FROM levels
"""
_ORACLES["transitive_closure"] = "SELECT * FROM closure"
_ORACLES["closure_extended"] = "SELECT * FROM closure"
_ORACLES["interval_labels"] = """
SELECT ancestor_concept_id, descendant_concept_id, CAST(1 AS BIGINT) AS root_concept_id FROM closure
UNION ALL SELECT DISTINCT concept_id, concept_id, 1 FROM levels
"""
_ORACLES["renewed_counts"] = """
SELECT a.ancestor_concept_id AS concept_id, count(DISTINCT m.person_id) AS patient_count
FROM ancestors a JOIN measurement m ON m.measurement_concept_id = a.descendant_concept_id GROUP BY 1
"""
_ORACLES["backfill_ancestors"] = "SELECT * FROM ancestors"
for _key, _table in {
    "lab_candidates": "candidates",
    "prune_leaves": "measured_leaves",
    "prune_parents": "pruned",
    "closure_counts": "counted",
    "single_parent_choice": "single",
    "lab_name_cleanup": "cleaned",
}.items():
    _ORACLES[_key] = f"SELECT {_COLUMNS}, concept_id, concept_name FROM {_table}"
_ORACLES["value_concepts"] = f"SELECT {_COLUMNS} FROM cat_labs"
_ORACLES["parent_link"] = """
SELECT CAST(row_number() OVER (ORDER BY external_id) AS BIGINT) AS id, external_id, external_parent_id AS parent, CAST(NULL AS VARCHAR) AS root
FROM (SELECT * FROM cat_visits UNION ALL SELECT * FROM cat_vitals)
"""
_TABLES["first_parents"] = """
SELECT concept_id_1 AS id, min(concept_id_2) AS parent_id FROM concept_relationship GROUP BY 1
"""
_TABLES["under_root"] = """
SELECT 1 AS id UNION ALL SELECT f.id FROM under_root u JOIN first_parents f ON f.parent_id = u.id
"""
_ORACLES["root_assign"] = """
SELECT concept_id AS id, CASE WHEN concept_id IN (SELECT id FROM under_root) THEN '1' END AS root FROM concept
"""
_ORACLES["build_catalog_omop"] = f"""
SELECT {_COLUMNS}, (SELECT min(p.external_id) FROM cat_omop p WHERE p.external_id = c.external_parent_id) AS parent,
       (SELECT min(r.root) FROM rooted_cat_omop r WHERE r.external_id = c.external_id) AS root
FROM cat_omop c
"""
_ORACLES["catalog_reload"] = _ORACLES["build_catalog_omop"].replace(" AS root\n", " AS root, CAST(1 AS BIGINT) AS same_id\n")
_ORACLES["build_catalog_pcornet"] = f"""
SELECT {_NAMED}, (SELECT min(p.external_id) FROM cat_pcornet p WHERE p.external_id = c.external_parent_id) AS parent,
       (SELECT min(r.root) FROM rooted_cat_pcornet r WHERE r.external_id = c.external_id) AS root
FROM cat_pcornet c
"""
_ORACLES["demographic_extract_omop"] = """
WITH used AS MATERIALIZED (
  SELECT concept_id, concept_name FROM concept
  WHERE concept_id IN (SELECT unnest([gender_concept_id, race_concept_id, ethnicity_concept_id]) FROM person)
)
SELECT CAST(p.person_id AS VARCHAR) AS "personId", zip AS "addressPostalCode", state AS "addressState",
       strftime(birth_datetime, '%Y-%m-%d 00:00:00') AS "birthDate", strftime(death_date, '%Y-%m-%d 00:00:00') AS "deceasedDateTime",
       e.concept_name AS ethnicity, g.concept_name AS gender, CASE WHEN d.person_id IS NULL THEN 0 ELSE 1 END AS "deceasedBoolean",
       CASE WHEN e.concept_name = 'Hispanic or Latino' THEN 1 ELSE 0 END AS "hispanicBoolean", 0 AS "marriedBoolean",
       CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS "maritalStatus", CAST(NULL AS VARCHAR) AS mrn,
       CAST(NULL AS VARCHAR) AS name, r.concept_name AS race, CAST(NULL AS VARCHAR) AS religion
FROM person p LEFT JOIN used g ON p.gender_concept_id = g.concept_id LEFT JOIN used r ON p.race_concept_id = r.concept_id
LEFT JOIN used e ON p.ethnicity_concept_id = e.concept_id LEFT JOIN location l ON p.location_id = l.location_id
LEFT JOIN death d ON p.person_id = d.person_id
"""
_ORACLES["demographic_extract_pcornet"] = f"""
SELECT patid AS "personId", '' AS "addressPostalCode", '' AS "addressState", strftime(birth_date, '%Y-%m-%d') AS "birthDate",
       (SELECT strftime(min(death_date), '%Y-%m-%d') FROM death WHERE person_id = patid) AS "deceasedDateTime",
       CASE hispanic WHEN 'Y' THEN 'Hispanic or Latino' ELSE 'Not Hispanic or Latino' END AS ethnicity,
       CASE sex WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'Other' END AS gender, 'Unknown' AS language,
       'Unknown' AS "maritalStatus", 0 AS "marriedBoolean", CASE WHEN hispanic = 'Y' THEN 1 ELSE 0 END AS "hispanicBoolean",
       CASE WHEN patid IN (SELECT person_id FROM death) THEN 1 ELSE 0 END AS "deceasedBoolean", 'Unknown Unknown' AS name,
       'Unknown' AS mrn, {_RACE} AS race, 'Unknown' AS religion
FROM demographic
"""
_TABLES["by_range"] = """
SELECT min_code, max_code, code_count, count(DISTINCT patid) AS n
FROM (SELECT DISTINCT min_code, max_code, code_count FROM minmax) r JOIN (SELECT DISTINCT dx, patid FROM diagnosis WHERE dx_type = '10') d
  ON CASE code_count WHEN 1 THEN dx = min_code WHEN 2 THEN dx IN (min_code, max_code) ELSE dx BETWEEN min_code AND max_code END
GROUP BY 1, 2, 3
"""
_ORACLES["cohort_counts"] = """
SELECT 'urn:leaf:concept:dx:icd10:' || i.id AS external_id, coalesce(n, 0) AS patient_count
FROM named_ids i LEFT JOIN by_range r ON i.min_code = r.min_code AND i.max_code = r.max_code AND i.code_count = r.code_count
WHERE parent_aui IS NOT NULL
UNION ALL
SELECT external_id, (SELECT count(DISTINCT patid) FROM diagnosis) FROM cat_icd10 WHERE sql_set_where IS NULL
"""
_ORACLES["cohort_counts_omop"] = """
SELECT external_id, ui_display_patient_count AS patient_count FROM cat_labs
UNION ALL
SELECT external_id, CASE WHEN external_id LIKE 'demographics:vital:deceased' THEN (SELECT count(DISTINCT person_id) FROM death)
                         WHEN sql_set_where IS NULL THEN (SELECT count(DISTINCT person_id) FROM person)
                         ELSE ui_display_patient_count END
FROM cat_demographics
"""
_ORACLES["cohort_counts_labels"] = _ORACLES["cohort_counts_omop"]
_ORACLES["numeric_concept_values"] = """
SELECT 'lab:' || measurement_concept_id AS external_id, person_id, value_as_number AS value FROM measurement
WHERE value_as_number IS NOT NULL AND measurement_concept_id IN (SELECT concept_id FROM cleaned WHERE is_numeric = 1)
UNION ALL
SELECT 'vitals:' || measurement_concept_id, person_id, value_as_number FROM measurement
WHERE value_as_number IS NOT NULL AND 'vitals:' || measurement_concept_id IN (SELECT external_id FROM cat_vitals WHERE is_numeric = 1)
UNION ALL
SELECT 'demographics:age', person_id, CAST(date_diff('day', birth_datetime, DATE '2024-01-01') AS DOUBLE) / CAST(365.25 AS DOUBLE) FROM person
"""
