"""The journal-line contract: column lists, types and fixed default values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the contract the pipeline is compatible with.
# ---------------------------------------------------------------------------

# The canonical 24 columns, in contract order.
CANONICAL_COLUMNS = [
    "surrogate_key", "source_system", "journal_id", "journal_line_num",
    "ledger_id", "effective_date", "period_name", "currency_code",
    "entered_dr", "entered_cr", "accounted_dr", "accounted_cr", "fx_rate",
    "segment1_entity", "segment2_cost_center", "segment3_account",
    "segment4_project", "segment5_intercompany", "segment6_product",
    "segment7_spare", "description", "batch_id", "load_timestamp", "payload_hash",
]

# Only the four amounts may be null.
AMOUNT_COLUMNS = ["entered_dr", "entered_cr", "accounted_dr", "accounted_cr"]

# The seven chart-of-accounts segments.
SEGMENT_COLUMNS = [
    "segment1_entity", "segment2_cost_center", "segment3_account",
    "segment4_project", "segment5_intercompany", "segment6_product",
    "segment7_spare",
]

# Reference-data list name for each segment, in segment order.
SEGMENT_REFERENCE_LISTS = {
    "segment1_entity": "entities",
    "segment2_cost_center": "cost_centers",
    "segment3_account": "accounts",
    "segment4_project": "projects",
    "segment5_intercompany": "ic_entities",
    "segment6_product": "products",
    "segment7_spare": "spare_values",
}

# The payload hash covers these 20 columns, in this order, joined by "||".
PAYLOAD_COLUMNS = [
    "journal_id", "journal_line_num", "ledger_id", "effective_date",
    "period_name", "currency_code", "entered_dr", "entered_cr",
    "accounted_dr", "accounted_cr", "fx_rate",
    "segment1_entity", "segment2_cost_center", "segment3_account",
    "segment4_project", "segment5_intercompany", "segment6_product",
    "segment7_spare", "description", "batch_id",
]

# The surrogate key covers these 5 columns; a null amount becomes "0", others "".
KEY_COLUMNS = ["source_system", "journal_id", "journal_line_num", "effective_date", "entered_dr"]
KEY_SEPARATOR = "||"

LEDGER_SOURCES = ["AP", "AR", "IC"]
SUPPORTED_GEOS = ["US", "EMEA", "APAC", "LATAM", "CANADA", "JAPAN", "INDIA", "UK"]
PERIOD_MONTHS = {"MONTHLY": 1, "QUARTERLY": 3, "YEARLY": 12}

BATCH_SOURCE_SYSTEM = "AR_FX"
STREAM_SOURCE_SYSTEM = "ICO_FX"
PRIMARY_LEDGER_SUFFIX = "-PRIMARY"
DEFAULT_SPARE = "000"
DEFAULT_APPROVER = "L7-manager"
BATCH_POSTED_BY = "fx-pipeline-service"
PERIOD_POSTED_BY = "period-pipeline-service"

# Defaults of a generated entry when the sub-ledger line lacks the field.
ENTRY_DEFAULT_CURRENCY = "USD"
ENTRY_DEFAULT_AMOUNT = "0"
ENTRY_DEFAULT_FX_RATE = "1.00000000"
ENTRY_DEFAULT_COST_CENTER = "DEFAULT"
ENTRY_DEFAULT_ACCOUNT = ""
ENTRY_DEFAULT_PROJECT = "NONE"
ENTRY_DEFAULT_INTERCOMPANY = "000"
ENTRY_DEFAULT_PRODUCT = "GENERAL"

# Check names used in validation reports.
CHECK_COLUMNS = "24_column_completeness"
CHECK_BALANCE = "dr_cr_balance"
CHECK_SEGMENTS = "7_segment_validity"

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------

AMOUNT_TYPE = T.DecimalType(20, 4)
# Sums and checks use this one, so that no digit of an amount is lost.
WIDE_AMOUNT_TYPE = T.DecimalType(38, 10)
RATE_TYPE = T.DecimalType(18, 8)
# Sums are reported at full precision so engines agree on the type.
SUM_TYPE = T.DecimalType(38, 4)

NON_NULLABLE_COLUMNS = [c for c in CANONICAL_COLUMNS if c not in AMOUNT_COLUMNS]


def _canonical_type(name: str) -> T.DataType:
    if name == "journal_line_num":
        return T.IntegerType()
    if name == "effective_date":
        return T.DateType()
    if name in AMOUNT_COLUMNS:
        return AMOUNT_TYPE
    if name == "fx_rate":
        return RATE_TYPE
    if name == "load_timestamp":
        return T.TimestampType()
    return T.StringType()


CANONICAL_SCHEMA = T.StructType(
    [T.StructField(c, _canonical_type(c), c in AMOUNT_COLUMNS) for c in CANONICAL_COLUMNS]
)
CANONICAL_TYPES = {f.name: f.dataType for f in CANONICAL_SCHEMA.fields}

# Issue report schema shared by every validation check.
#: The place of a row in its source file, from 1.
ORDINAL = "row_ordinal"

ISSUE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("journal_id", T.StringType()),
    T.StructField("journal_line_num", T.IntegerType()),
    T.StructField("column", T.StringType()),
    T.StructField("detail", T.StringType()),
])
