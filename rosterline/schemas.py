"""Fixed source layouts and curated names.

Raw files are read as all-string columns bound by *header name*; the lists
below say which headers are selected, what they are called once curated and
which type they are converted to.  Types are never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the source datasets' published layouts).
# --------------------------------------------------------------------------

# Daily staffing file: identifying / dimension headers and their curated name.
STAFFING_DIMENSIONS = [
    ("PROVNUM", "provnum"),
    ("PROVNAME", "provname"),
    ("CITY", "city"),
    ("STATE", "state"),
    ("COUNTY_NAME", "county_name"),
    ("COUNTY_FIPS", "county_fips"),
    ("CY_Qtr", "cy_qtr"),
]
STAFFING_DATE = ("WorkDate", "workdate")
STAFFING_DATE_FORMAT = "yyyyMMdd"
STAFFING_CENSUS = ("MDScensus", "mdscensus")

# Staffing roles, in file order; each role has a total, employee and contract column.
STAFF_ROLES = ["RNDON", "RNadmin", "RN", "LPNadmin", "LPN", "CNA", "NAtrn", "MedAide"]
HOUR_SUFFIXES = ["", "_emp", "_ctr"]

# Direct-care roles that make up total direct hours.
DIRECT_ROLES = ["RN", "LPN", "CNA"]

# Roles whose total must equal employee + contractor hours (label, role).
RECONCILED_ROLES = [
    ("RN", "RN"),
    ("LPN", "LPN"),
    ("CNA", "CNA"),
    ("NA Training", "NAtrn"),
    ("Med Aide", "MedAide"),
]
RECONCILE_TOLERANCE = 0.01

# Provider information file: source header, curated name, type.
PROVIDER_COLUMNS = [
    ("CMS Certification Number (CCN)", "provider_id", "string"),
    ("Provider Name", "provider_name", "string"),
    ("Provider Address", "provider_address", "string"),
    ("City/Town", "city", "string"),
    ("State", "state", "string"),
    ("ZIP Code", "zip_code", "string"),
    ("County/Parish", "county", "string"),
    ("Ownership Type", "ownership_type", "string"),
    ("Number of Certified Beds", "certified_beds", "double"),
    ("Average Number of Residents per Day", "avg_residents_per_day", "double"),
    ("Provider Type", "provider_type", "string"),
    ("Overall Rating", "overall_rating", "double"),
    ("Health Inspection Rating", "health_inspection_rating", "double"),
    ("QM Rating", "qm_rating", "double"),
    ("Staffing Rating", "staffing_rating", "double"),
]

# Claims quality file: source header, curated name, type.
CLAIMS_COLUMNS = [
    ("CMS Certification Number (CCN)", "provider_id", "string"),
    ("Measure Code", "measure_code", "int"),
    ("Measure Description", "measure_description", "string"),
    ("Resident type", "resident_type", "string"),
    ("Adjusted Score", "adjusted_score", "double"),
    ("Observed Score", "observed_score", "double"),
    ("Expected Score", "expected_score", "double"),
    ("Used in Quality Measure Five Star Rating", "used_in_five_star", "string"),
    ("Measure Period", "measure_period", "string"),
    ("Processing Date", "processing_date", "date"),
]
CLAIMS_DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd"]

# Claims measure codes and the facility-level column each one pivots into.
MEASURES = [
    (521, "rehospitalization_rate"),
    (522, "short_stay_ed_rate"),
    (551, "hospitalizations_per_1000"),
    (552, "long_stay_ed_visits_per_1000"),
]

# Provider attributes carried onto the enriched daily table (curated -> enriched name).
PROVIDER_ENRICHMENT = [
    ("provider_name", "provider_name"),
    ("provider_address", "provider_address"),
    ("city", "provider_city"),
    ("state", "provider_state"),
    ("zip_code", "provider_zip_code"),
    ("county", "provider_county"),
    ("ownership_type", "provider_ownership_type"),
    ("certified_beds", "provider_certified_beds"),
    ("avg_residents_per_day", "provider_avg_residents_per_day"),
    ("provider_type", "provider_type"),
    ("overall_rating", "provider_overall_rating"),
    ("health_inspection_rating", "provider_health_inspection_rating"),
    ("qm_rating", "provider_qm_rating"),
    ("staffing_rating", "provider_staffing_rating"),
]

RATINGS = ["overall_rating", "health_inspection_rating", "qm_rating", "staffing_rating"]

# Staffing bands on facility total direct HPRD: (upper bound exclusive, label).
STAFFING_BANDS = [
    (3.0, "< 3.0 HPRD"),
    (4.0, "3.0 - 3.99 HPRD"),
    (5.0, "4.0 - 4.99 HPRD"),
]
TOP_BAND = "5.0+ HPRD"

# Pearson correlations published by the correlation view: (name, x, y, label).
CORRELATIONS = [
    ("hprd_vs_rehospitalization", "total_direct_hprd", "rehospitalization_rate",
     "Total HPRD vs Rehospitalization"),
    ("hprd_vs_short_stay_ed", "total_direct_hprd", "short_stay_ed_rate",
     "Total HPRD vs Short-Stay ED"),
    ("hprd_vs_hospitalizations", "total_direct_hprd", "hospitalizations_per_1000",
     "Total HPRD vs Hospitalizations"),
    ("hprd_vs_long_stay_ed", "total_direct_hprd", "long_stay_ed_visits_per_1000",
     "Total HPRD vs Long-Stay ED"),
    ("hprd_vs_overall_rating", "total_direct_hprd", "overall_rating",
     "Total HPRD vs Overall Rating"),
    ("hprd_vs_staffing_rating", "total_direct_hprd", "staffing_rating",
     "Total HPRD vs Staffing Rating"),
    ("rn_vs_rehospitalization", "rn_hprd", "rehospitalization_rate",
     "RN HPRD vs Rehospitalization"),
    ("rn_vs_short_stay_ed", "rn_hprd", "short_stay_ed_rate",
     "RN HPRD vs Short-Stay ED"),
    ("rn_vs_hospitalizations", "rn_hprd", "hospitalizations_per_1000",
     "RN HPRD vs Hospitalizations"),
    ("rn_vs_long_stay_ed", "rn_hprd", "long_stay_ed_visits_per_1000",
     "RN HPRD vs Long-Stay ED"),
]

# State ranking metric choices: (label, column of the state overview).
RANKING_METRICS = [
    ("Total Direct HPRD", "total_direct_hprd"),
    ("RN HPRD", "rn_hprd"),
    ("LPN HPRD", "lpn_hprd"),
    ("CNA HPRD", "cna_hprd"),
    ("Contract Dependency %", "contract_dependency_pct"),
    ("Overall Rating", "avg_overall_rating"),
    ("Staffing Rating", "avg_staffing_rating"),
]

# Wide-to-long reshapes for the state panel: (label, column).
STAFFING_MIX = [("RN", "rn_hprd"), ("LPN", "lpn_hprd"), ("CNA", "cna_hprd")]
RATING_LABELS = [
    ("Overall", "avg_overall_rating"),
    ("Health Inspection", "avg_health_inspection_rating"),
    ("Quality Measure", "avg_qm_rating"),
    ("Staffing", "avg_staffing_rating"),
]

# Display tables: columns in order, and those rounded for display.
EXPLORER_TABLE_COLUMNS = [
    "provnum", "provider_name", "city", "ownership_type", "certified_beds",
    "overall_rating", "staffing_rating", "rn_hprd", "lpn_hprd", "cna_hprd",
    "total_direct_hprd", "contract_dependency_pct", "rehospitalization_rate",
    "short_stay_ed_rate", "hospitalizations_per_1000", "long_stay_ed_visits_per_1000",
]
EXPLORER_ROUNDED = [
    "rn_hprd", "lpn_hprd", "cna_hprd", "total_direct_hprd", "contract_dependency_pct",
    "rehospitalization_rate", "short_stay_ed_rate", "hospitalizations_per_1000",
    "long_stay_ed_visits_per_1000",
]
TREND_COLUMNS = [
    "workdate", "mdscensus", "rn_hprd", "lpn_hprd", "cna_hprd",
    "total_direct_hprd", "contract_dependency_pct",
]
STATE_TABLE_ROUNDED = [
    "total_resident_days", "rn_hprd", "lpn_hprd", "cna_hprd", "total_direct_hprd",
    "contract_dependency_pct", "avg_overall_rating", "avg_health_inspection_rating",
    "avg_qm_rating", "avg_staffing_rating",
]
BAND_AVERAGES = [
    "avg_total_hprd", "avg_rehospitalization_rate", "avg_short_stay_ed_rate",
    "avg_overall_rating", "avg_staffing_rating",
]

UNKNOWN_FACILITY = "Unknown Facility"
LABEL_SEPARATOR = " — "

# Coverage guard: share of staffing facilities that must match a provider row.
MIN_JOIN_COVERAGE_PCT = 95.0

# Incremental file manifest: listing mime types.
FOLDER_MIME = "application/vnd.google-apps.folder"
NATIVE_DOC_PREFIX = "application/vnd.google-apps."

# --------------------------------------------------------------------------
# Derived names and curated schemas.
# --------------------------------------------------------------------------


def hour_columns() -> list[tuple[str, str]]:
    """(source header, curated name) for the 24 staffing hour columns."""
    return [
        (f"Hrs_{role}{suffix}", f"hrs_{role.lower()}{suffix}")
        for role in STAFF_ROLES
        for suffix in HOUR_SUFFIXES
    ]


HOUR_COLUMNS = [name for _, name in hour_columns()]


def hrs(role: str, suffix: str = "") -> str:
    return f"hrs_{role.lower()}{suffix}"


STAFFING_SOURCE_HEADERS = (
    [h for h, _ in STAFFING_DIMENSIONS]
    + [STAFFING_DATE[0], STAFFING_CENSUS[0]]
    + [h for h, _ in hour_columns()]
)

STAFFING_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for _, name in STAFFING_DIMENSIONS]
    + [
        T.StructField("workdate", T.DateType()),
        T.StructField("mdscensus", T.DoubleType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in HOUR_COLUMNS]
)

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
          "date": T.DateType()}

PROVIDER_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES[t]) for _, name, t in PROVIDER_COLUMNS]
)
CLAIMS_SCHEMA = T.StructType([T.StructField(name, _TYPES[t]) for _, name, t in CLAIMS_COLUMNS])

_DERIVED = [
    "total_direct_hours", "contract_direct_hours", "rn_hprd", "lpn_hprd", "cna_hprd",
    "total_direct_hprd", "contract_dependency_pct",
]
_PROVIDER_TYPE = {name: _TYPES[t] for _, name, t in PROVIDER_COLUMNS}
_STAMP = T.TimestampType()

# Published tables: the enriched daily table (partitioned by state) and the claims.
FACILITY_METRICS_SCHEMA = T.StructType(
    [*STAFFING_SCHEMA.fields]
    + [T.StructField(n, T.DoubleType()) for n in _DERIVED]
    + [T.StructField("etl_processed_at", _STAMP)]
    + [T.StructField(dst, _PROVIDER_TYPE[src]) for src, dst in PROVIDER_ENRICHMENT]
    + [T.StructField("facility_metrics_processed_at", _STAMP)]
)
PUBLISHED_CLAIMS_SCHEMA = T.StructType([*CLAIMS_SCHEMA.fields, T.StructField("etl_processed_at", _STAMP)])

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("file_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("modified_time", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("target_key", T.StringType()),
    ]
)
