"""The claims business, derived from the TPC-H-like test tables.

customer -> claimants, supplier -> employers, part -> policies, orders -> claims (two
file versions that overlap in time), lineitem -> payments.  Every row of each table
takes part.  The text runs unchanged in Spark SQL and in the oracle.  Dates move by
9131 days (25 years), from 1995-2001 into the calendar.  Rows with a negative balance
(customers, suppliers) or a small size (parts) also bring an older version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CLAIM = """
    o_orderkey AS claim_id, o_custkey AS claimant_id,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(floor(o_orderkey / 7) AS BIGINT) END AS policy_id,
    CAST(o_orderdate AS DATE) + 9131 AS incident_date,
    CAST(o_orderdate AS DATE) + 9131 + CAST(o_orderkey % 30 AS INTEGER) AS report_date,
    o_orderpriority AS claim_type,
    CASE o_orderstatus WHEN 'F' THEN ' Closed' WHEN 'O' THEN 'OPEN' ELSE 'Denied ' END AS claim_status"""

_CLAIM_END = """
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice - 100 END AS approved_amount,
    TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-02 00:00:00' AS updated_at"""

SOURCES = {
    "claimants": """
        SELECT c_custkey AS claimant_id, concat('  ', c_name, ' ') AS first_name, c_mktsegment AS last_name,
               DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS date_of_birth,
               CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS gender,
               DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS employment_start_date,
               CAST(floor(c_custkey / 12) AS BIGINT) AS employer_id,
               TIMESTAMP '2023-01-01 08:00:00' AS created_at, TIMESTAMP '2024-01-01 08:00:00' AS updated_at
        FROM customer
        UNION ALL
        SELECT c_custkey, c_name, c_mktsegment,
               DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER), 'F',
               DATE '2015-01-01' + CAST(c_custkey % 2000 AS INTEGER),
               CAST(floor(c_custkey / 12) AS BIGINT) + 1,
               TIMESTAMP '2022-01-01 08:00:00', TIMESTAMP '2022-06-01 08:00:00'
        FROM customer WHERE c_acctbal < 0""",
    "employers": """
        SELECT s_suppkey AS employer_id, concat(s_name, ' ') AS company_name, r_name AS industry,
               concat('City ', n_name) AS location, s_suppkey * 3 AS policy_id,
               TIMESTAMP '2023-02-01 08:00:00' AS created_at, TIMESTAMP '2024-01-01 08:00:00' AS updated_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT s_suppkey, s_name, r_name, concat('Old ', n_name), s_suppkey * 3,
               TIMESTAMP '2022-02-01 08:00:00', TIMESTAMP '2022-06-01 08:00:00'
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE s_acctbal < 0""",
    "policies": """
        SELECT p_partkey AS policy_id, concat('POL', CAST(p_partkey AS VARCHAR(20))) AS policy_number,
               CASE WHEN p_size % 2 = 0 THEN 'Full' ELSE 'Partial' END AS coverage_type,
               DATE '2020-01-01' + p_size AS start_date, DATE '2021-01-01' + p_size AS end_date,
               p_retailprice AS premium_amount,
               TIMESTAMP '2023-03-01 08:00:00' AS created_at, TIMESTAMP '2024-01-01 08:00:00' AS updated_at
        FROM part
        UNION ALL
        SELECT p_partkey, concat('POL', CAST(p_partkey AS VARCHAR(20))), 'Basic',
               DATE '2019-01-01' + p_size, DATE '2020-01-01' + p_size, p_retailprice - 10,
               TIMESTAMP '2022-03-01 08:00:00', TIMESTAMP '2022-06-01 08:00:00'
        FROM part WHERE p_size < 5""",
    "claims_v1": f"""
        SELECT {_CLAIM}, o_totalprice + 1 AS claim_amount, {_CLAIM_END}
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'""",
    "claims_v2": f"""
        SELECT {_CLAIM}, o_totalprice AS claim_amount, {_CLAIM_END},
               CASE o_orderkey % 5 WHEN 0 THEN 'low' WHEN 1 THEN 'high' ELSE 'medium' END AS claim_severity
        FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'""",
    "payments": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS claim_id,
               CAST(l_shipdate AS DATE) + 9131 AS payment_date, l_extendedprice AS payment_amount,
               l_returnflag AS payment_type,
               CASE l_linestatus WHEN 'O' THEN TIMESTAMP '2024-01-01 00:00:00'
                                 ELSE TIMESTAMP '2024-01-02 00:00:00' END AS created_at
        FROM lineitem""",
    # A dimension whose history nobody has looked after: every order is one version of
    # its customer, with gaps, overlaps, several open rows, and ends before starts.
    "history": """
        SELECT o_orderkey AS claimant_key, o_custkey AS claimant_id, o_orderpriority AS gender,
               CAST(o_orderdate AS DATE) + 9131 AS effective_from,
               CASE WHEN o_orderstatus = 'P' THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + 9121 + CAST(o_orderkey % 200 AS INTEGER) END AS effective_to,
               o_orderstatus = 'P' AS is_current
        FROM orders""",
}

# The same sources as delivered on two days.  On day two one segment is new, another
# is missing, tracked and untracked attributes change and some tracked ones go NULL.
DAYS = {
    ("claimants", 1): "SELECT * FROM claimants WHERE last_name <> 'MACHINERY'",
    ("claimants", 2): """
        SELECT claimant_id, first_name,
               CASE WHEN claimant_id % 5 = 0 THEN concat(last_name, '-x') ELSE last_name END AS last_name,
               date_of_birth, CASE WHEN claimant_id % 4 = 0 THEN 'X' ELSE gender END AS gender,
               employment_start_date,
               CASE WHEN claimant_id % 13 = 0 THEN NULL ELSE employer_id END AS employer_id,
               created_at, updated_at
        FROM claimants WHERE last_name <> 'FURNITURE'""",
    ("employers", 1): "SELECT * FROM employers WHERE industry <> 'ASIA'",
    ("employers", 2): """
        SELECT employer_id, concat(company_name, 'Ltd') AS company_name,
               CASE WHEN employer_id % 4 = 0 THEN 'MARS' ELSE industry END AS industry,
               CASE WHEN employer_id % 7 = 0 THEN NULL ELSE location END AS location,
               policy_id, created_at, updated_at
        FROM employers WHERE industry <> 'EUROPE'""",
    ("policies", 1): "SELECT * FROM policies WHERE start_date > DATE '2020-01-06'",
    ("policies", 2): """
        SELECT policy_id, policy_number,
               CASE WHEN policy_id % 6 = 0 THEN 'Premium' WHEN policy_id % 11 = 0 THEN NULL
                    ELSE coverage_type END AS coverage_type,
               start_date, end_date, premium_amount + 1 AS premium_amount, created_at, updated_at
        FROM policies WHERE start_date < DATE '2020-01-01' + 45""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source as a DataFrame over the Parquet tables."""
    for table in [t for t in TABLES if t in SOURCES[name]]:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(SOURCES[name])


def source_on(spark: SparkSession, sf_dir: str, name: str, day: int) -> DataFrame:
    """One source as delivered on day 1 or 2."""
    source(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(DAYS[(name, day)])


# Faults put into a loaded star: columns as they then are, in SQL that both engines read.
FAULTS = {
    "fact_claim": {
        "claim_id": "CASE WHEN claim_id % 17 <> 0 THEN claim_id END",
        "claimant_key": "CASE WHEN claim_id % 7 = 0 THEN -1 ELSE claimant_key END",
        "claim_amount": "CASE WHEN claim_id % 11 = 0 THEN -1 ELSE claim_amount END",
        "claim_status": "CASE WHEN claim_id % 13 = 0 THEN 'lost' ELSE claim_status END",
        "incident_date_key": "CASE WHEN claim_id % 23 = 0 THEN 19000101 ELSE incident_date_key END",
    },
    "fact_payment": {
        "claim_key": "CASE WHEN payment_id % 5 = 0 THEN NULL WHEN payment_id % 6 = 0 THEN -5 ELSE claim_key END",
    },
    "dim_claimant": {"claimant_id": "CASE WHEN claimant_id % 10 <> 3 THEN claimant_id END"},
    "dim_policy": {"policy_id": "CASE WHEN policy_id % 10 <> 3 THEN policy_id END"},
}
# Rows that are there twice.
REPEATED = {
    "fact_claim": "claim_id % 19 = 0",
    "fact_payment": "payment_id % 29 = 0",
    "dim_claimant": "is_current AND claimant_id % 9 = 0",
    "dim_policy": "is_current AND policy_id % 9 = 0",
    "dim_employer": "is_current AND employer_id % 9 = 0",
}
