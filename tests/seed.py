"""Dimension rows for tests: the modelled system's ids and prices, invented people."""

import datetime as d
from decimal import Decimal

# Customers 1-25; names, phone numbers and dates are made by rule, as no result depends on them.
CUSTOMERS = [
    (i, f"First{i}", f"Last{i}", "Delhi", "122009", f"91{i:08d}", f"{2020 + i % 4}-{i % 12 + 1:02d}-{i:02d}") for i in range(1, 26)
]

# Stores 121-124 (id, address, pincode, manager, opened, review).
STORES = [(i, "Delhi", f"1100{i - 110}", f"Manager{i}", f"20{i - 101}-01-15", f"review of store {i}") for i in range(121, 125)]

# --- fixed values: product seed rows (name, current price, old price, created, expiry) ---
PRODUCTS = [
    ("quaker oats", "212", "212", "2022-05-15", "2025-01-01"),
    ("sugar", "50", "50", "2021-08-10", "2025-01-01"),
    ("maida", "20", "20", "2023-03-20", "2025-01-01"),
    ("besan", "52", "52", "2020-05-05", "2025-01-01"),
    ("refined oil", "110", "110", "2022-01-15", "2025-01-01"),
    ("clinic plus", "1.5", "1.5", "2021-09-25", "2025-01-01"),
    ("dantkanti", "100", "100", "2023-07-10", "2025-01-01"),
    ("nutshell", "40", "40", "2020-11-30", "2025-01-01"),
]

# Sellers 1-10; the tenth manages the others (first, last, manager id, is manager, address, pincode, joined).
SALES_TEAM = [(f"Seller{i}", f"Name{i}", 10, "Y" if i == 10 else "N", "Delhi", "122007", "2020-05-01") for i in range(1, 11)]


def _d(s):
    return d.date.fromisoformat(s) if s else None


def dimensions(spark):
    """(customer, store, product, sales_team) DataFrames in the model's schemas."""
    from salesmart.schema import CUSTOMER_SCHEMA, PRODUCT_SCHEMA, SALES_TEAM_SCHEMA, STORE_SCHEMA

    customer = spark.createDataFrame([(*r[:6], _d(r[6])) for r in CUSTOMERS], CUSTOMER_SCHEMA)
    store = spark.createDataFrame([(*r[:4], _d(r[4]), r[5]) for r in STORES], STORE_SCHEMA)
    product = spark.createDataFrame(
        [
            (i + 1, n, Decimal(c), Decimal(o), d.datetime.fromisoformat(cr), None, _d(e))
            for i, (n, c, o, cr, e) in enumerate(PRODUCTS)
        ],
        PRODUCT_SCHEMA,
    )
    team = spark.createDataFrame([(i + 1, *r[:6], _d(r[6])) for i, r in enumerate(SALES_TEAM)], SALES_TEAM_SCHEMA)
    return customer, store, product, team
