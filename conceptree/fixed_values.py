"""Lists and text formats that the catalogs must contain exactly."""

# ---------------------------------------------------------------- fixed values: registry
# (dataset, encounter based, event based, date field)
OMOP_DATASETS = [
    ("dbo.person", False, False, None),
    ("dbo.visit_occurrence", True, False, "@.visit_start_datetime"),
    ("dbo.condition_occurrence", True, False, "@.condition_start_datetime"),
    ("dbo.v_death", True, False, "@.death_datetime"),
    ("dbo.device_exposure", True, False, "@.device_exposure_start_datetime"),
    ("dbo.drug_exposure", True, False, "@.drug_exposure_start_datetime"),
    ("dbo.measurement", True, False, "@.measurement_datetime"),
    ("dbo.observation", True, False, "@.observation_datetime"),
    ("dbo.procedure_occurrence", True, False, "@.procedure_datetime"),
]
PCORNET_DATASETS = [
    ("dbo.DEMOGRAPHIC", False, False, None),
    ("dbo.ENCOUNTER", True, False, "@.ADMIT_DATE"),
    ("dbo.DIAGNOSIS", True, False, "@.DX_DATE"),
    ("dbo.PROCEDURES", True, False, "@.PX_DATE"),
    ("dbo.VITAL", True, False, "@.MEASURE_DATE"),
    ("dbo.LAB_RESULT_CM", True, False, "@.SPECIMEN_DATE"),
    ("dbo.DEATH", True, False, "@.DEATH_DATE"),
    ("dbo.IMMUNIZATION", True, False, "@.VX_ADMIN_DATE"),
]

# ---------------------------------------------- fixed values: OMOP demographics and visits
# (external id, parent, numeric, parent flag, root flag, dataset, where, numeric field,
#  name, text, units, text for any number, predicate kind)
OMOP_DEMOGRAPHICS = [
    ("demographics", None, False, True, True, "dbo.person", None, None,
     "Demographics", "Have demographics", None, None, "all"),
    ("demographics:gender", "demographics", False, True, False, "dbo.person", None, None,
     "Gender", "Have gender data", None, None, "all"),
    ("demographics:ethnicity", "demographics", False, True, False, "dbo.person", None, None,
     "Ethnicity", "Have ethnicity data", None, None, "all"),
    ("demographics:race", "demographics", False, True, False, "dbo.person", None, None,
     "Race", "Have race data", None, None, "all"),
    ("demographics:age", "demographics", True, False, False, "dbo.person", None,
     "/* Current Age */ (DATEDIFF(DAY, @.birth_datetime, GETDATE()) / 365.25)",
     "Age", "Are", "years old", "any current age", "all"),
    ("demographics:vital", "demographics", False, True, False, "dbo.person", None, None,
     "Vital Status", "Are living or deceased", None, None, "all"),
    ("demographics:vital:living", "demographics:vital", False, False, False, "dbo.person",
     "/* Not deceased */ NOT EXISTS (SELECT 1 FROM dbo.death AS @D WHERE @.person_id = @D.person_id)", None,
     "Living", "Are living or not known to be deceased", None, None, "not_exists"),
    ("demographics:vital:deceased", "demographics:vital", False, False, False, "dbo.v_death", None, None,
     "Deceased", "Are known to be deceased", None, None, "all"),
]
OMOP_VISITS_ROOT = (
    "visit", None, False, True, True, "dbo.visit_occurrence", None, None,
    "Encounters", "Have had an encounter", None, None, "all",
)
OMOP_VITALS_ROOT = (
    "vitals", None, False, True, True, "dbo.measurement", None, None,
    "Vitals", "Had vitals measured", None, None, "all",
)
# (measurement, concept id); heart rate and pulse share one
VITAL_CONCEPT_IDS = {
    "temperature": 3020891,
    "heart rate": 3027018,
    "respiratory rate": 3024171,
    "diastolic pressure": 3012888,
    "systolic pressure": 3004249,
    "weight": 3025315,
    "height": 3036277,
    "pulse": 3027018,
    "body mass index": 40540383,
}

# -------------------------------------------------------------------- fixed values: labs
LAB_ROOT_CONCEPT_ID = 36206173
LAB_VOCABULARY = "LOINC"
LAB_RELATIONSHIP = "Is a"
LAB_DATASET = "dbo.measurement"
# The runs of spaces are part of the text.
LAB_PARENT_WHERE = (
    "EXISTS (SELECT 1"
    "          FROM dbo.concept_ancestor AS @CA"
    "          WHERE @CA.descendant_concept_id = @.measurement_concept_id"
    "                AND @CA.ancestor_concept_id = "
)

# ----------------------------------------------------- fixed values: PCORnet fixed catalog
URN = "urn:leaf:concept:"
# (id after the urn, parent, numeric, parent flag, root flag, dataset, where, numeric field,
#  name, text, units, text for any number, predicate kind)
PCORNET_FIXED = [
    ("demographic", None, False, True, True, "dbo.DEMOGRAPHIC", None, None,
     "Demographics", "Have demographics", None, None, "all"),
    ("demographic:sex", "demographic", False, True, False, "dbo.DEMOGRAPHIC", None, None,
     "Sex", "Identify with a sex", None, None, "all"),
    ("demographic:sex:F", "demographic:sex", False, False, False, "dbo.DEMOGRAPHIC", "@.SEX = 'F'", None,
     "Female", "Were female at birth", None, None, "eq"),
    ("demographic:sex:M", "demographic:sex", False, False, False, "dbo.DEMOGRAPHIC", "@.SEX = 'M'", None,
     "Male", "Were male at birth", None, None, "eq"),
    ("demographic:ethnicity", "demographic", False, True, False, "dbo.DEMOGRAPHIC", None, None,
     "Ethnicity", "Have ethnicity data", None, None, "all"),
    ("demographic:ethnicity:Y", "demographic:ethnicity", False, False, False, "dbo.DEMOGRAPHIC",
     "@.HISPANIC = 'Y'", None, "Hispanic", "Identify as Hispanic", None, None, "eq"),
    ("demographic:ethnicity:N", "demographic:ethnicity", False, False, False, "dbo.DEMOGRAPHIC",
     "@.HISPANIC = 'N'", None, "Not Hispanic", "Identify as non-Hispanic", None, None, "eq"),
    ("demographic:ethnicity:U", "demographic:ethnicity", False, False, False, "dbo.DEMOGRAPHIC",
     "@.HISPANIC = 'U'", None, "Unknown", "Hispanic idenfication is Unknown", None, None, "eq"),
    ("demographic:race", "demographic", False, True, False, "dbo.DEMOGRAPHIC", None, None,
     "Race", "Identify as one or more races", None, None, "all"),
    ("demographic:race:01", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '01'", None,
     "American Indian or Alaska Native", "Identify as American Indian or Alaska Native", None, None, "eq"),
    ("demographic:race:02", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '02'", None,
     "Asian", "Identify as Asian", None, None, "eq"),
    ("demographic:race:03", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '03'", None,
     "Black or African American", "Identify as Black or African American", None, None, "eq"),
    ("demographic:race:04", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '04'", None,
     "Native Hawaiian or Pacific Islander", "Identify as Native Hawaiian or Pacific Islander", None, None, "eq"),
    ("demographic:race:05", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '05'", None,
     "White", "Identify as White", None, None, "eq"),
    ("demographic:race:06", "demographic:race", False, False, False, "dbo.DEMOGRAPHIC", "@.RACE = '06'", None,
     "Multiple races", "Identify as multiple races", None, None, "eq"),
    ("demographic:age", "demographic", True, False, False, "dbo.DEMOGRAPHIC", None,
     "/* Current Age */ (DATEDIFF(DAY, @.BIRTH_DATE, GETDATE()) / 365.25)",
     "Age", "Are", "years old", "any current age", "all"),
    ("demographic:vital", "demographic", False, True, False, "dbo.DEMOGRAPHIC", None, None,
     "Vital Status", "Have a vital status", None, None, "all"),
    ("demographic:vital:L", "demographic:vital", False, False, False, "dbo.DEMOGRAPHIC",
     "NOT EXISTS (SELECT 1 FROM dbo.DEATH AS @D WHERE @.PATID = @D.PATID)", None,
     "Living", "Patients are living", None, None, "not_exists"),
    ("demographic:vital:D", "demographic:vital", False, False, False, "dbo.DEMOGRAPHIC",
     "EXISTS (SELECT 1 FROM dbo.DEATH AS @D WHERE @.PATID = @D.PATID)", None,
     "Deceased", "Patients are deceased", None, None, "exists"),
    ("encounter", None, False, True, True, "dbo.ENCOUNTER", None, None,
     "Encounters", "Have had an encounter", None, None, "all"),
    ("encounter:AV", "encounter", False, False, False, "dbo.ENCOUNTER", "@.ENC_TYPE = 'AV'", None,
     "Outpatient", "Had an Outpatient visit", None, None, "eq"),
    ("encounter:ED", "encounter", False, False, False, "dbo.ENCOUNTER", "@.ENC_TYPE = 'ED'", None,
     "Emergency", "Visited the Emergency department", None, None, "eq"),
    ("encounter:EI", "encounter", False, False, False, "dbo.ENCOUNTER", "@.ENC_TYPE = 'EI'", None,
     "Emergency/Inpatient", "Visited the Emergency department and admitted as Inpatient", None, None, "eq"),
    ("encounter:IP", "encounter", False, False, False, "dbo.ENCOUNTER", "@.ENC_TYPE = 'IP'", None,
     "Inpatient", "Admitted as an Inpatient", None, None, "eq"),
]

# ------------------------------------------------ fixed values: PCORnet vocabulary catalogs
PROCEDURES_ICD10PCS_TOP_AUI = "A16077350"

# ----------------------------------------------- fixed values: PCORnet demographic extract
PCORNET_SEX = {"F": "Female", "M": "Male"}
PCORNET_RACE = {
    "05": "White",
    "03": "Black or African American",
    "02": "Asian",
    "04": "Native Hawaiian or Other Pacific Islander",
    "01": "American Indian or Alaska Native",
    "06": "Multi-racial",
    "NI": "Unknown",
    "UN": "Unknown",
    "OT": "Other",
}
HISPANIC = "Hispanic or Latino"
NOT_HISPANIC = "Not Hispanic or Latino"
