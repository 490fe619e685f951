"""Fixed schemas and fixed values of the sales-mart model.

Everything in this module is a value that must stay equal to the modelled
retail system for results to be right (column names, layouts, seed domains).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: mandatory header of a landed sales file, in file order ---
MANDATORY_COLUMNS = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]

# --- fixed values: separator used when folding extra columns into one ---
EXTRA_SEPARATOR = ", "

# --- fixed values: ledger status codes (A = started, I = finished) ---
STATUS_STARTED = "A"
STATUS_FINISHED = "I"
# Statuses of this package: E = rejected by the audit, R = replaced by a newer version of the file.
STATUS_REJECTED = "E"
STATUS_RETRACTED = "R"

MONEY = T.DecimalType(10, 2)

# Type of each mandatory column when a landed CSV is read.
MANDATORY_TYPES: dict[str, T.DataType] = {
    "customer_id": T.LongType(),
    "store_id": T.LongType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
}

ADDITIONAL_COLUMN = "additional_column"
CORRUPT_COLUMN = "_corrupt_record"

FACT_SCHEMA = T.StructType(
    [T.StructField(c, MANDATORY_TYPES[c], True) for c in MANDATORY_COLUMNS]
    + [T.StructField(ADDITIONAL_COLUMN, T.StringType(), True)]
)

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("customer_joining_date", T.DateType()),
    ]
)

STORE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("address", T.StringType()),
        T.StructField("store_pincode", T.StringType()),
        T.StructField("store_manager_name", T.StringType()),
        T.StructField("store_opening_date", T.DateType()),
        T.StructField("reviews", T.StringType()),
    ]
)

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", MONEY),
        T.StructField("old_price", MONEY),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("updated_date", T.TimestampNTZType()),
        T.StructField("expiry_date", T.DateType()),
    ]
)

SALES_TEAM_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("manager_id", T.IntegerType()),
        T.StructField("is_manager", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("pincode", T.StringType()),
        T.StructField("joining_date", T.DateType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_location", T.StringType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("updated_date", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        # Identity of the landed file version (epoch ms); null for files without metadata.
        T.StructField("file_modified_ms", T.LongType()),
    ]
)

# The stored ledger also names the run that an event belongs to.
LEDGER_FILE_SCHEMA = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("run_id", T.LongType())])

CUSTOMER_MONTH_MART_COLUMNS = [
    "customer_id",
    "full_name",
    "address",
    "phone_number",
    "sales_date_month",
    "total_sales",
]

SALES_TEAM_MONTH_MART_COLUMNS = [
    "store_id",
    "sales_person_id",
    "full_name",
    "sales_month",
    "total_sales",
    "incentive",
]

# --- fixed values: seed domains of the synthetic sales generator ---
SYNTH_CUSTOMER_IDS = (1, 20)          # inclusive range
SYNTH_STORE_IDS = (121, 123)          # inclusive range
SYNTH_SELLERS_PER_STORE = 3           # store 121 -> 1..3, 122 -> 4..6, 123 -> 7..9
SYNTH_QUANTITY = (1, 10)              # inclusive range
SYNTH_DATE_RANGE = ("2023-03-03", "2023-08-20")
SYNTH_PAYMENT_MODES = ["cash", "UPI"]
SYNTH_PRODUCTS = [
    ("quaker oats", "212"),
    ("sugar", "50"),
    ("maida", "20"),
    ("besan", "52"),
    ("refined oil", "110"),
    ("clinic plus", "1.5"),
    ("dantkanti", "100"),
    ("nutshell", "40"),
]
SYNTH_CUSTOMER_ADDRESS = "Delhi"
SYNTH_CUSTOMER_PINCODE = "122009"
SYNTH_JOINING_RANGE = ("2020-01-01", "2023-08-20")
