"""What the warehouse looks like: file contracts, table schemas, dimensions.

Natural and surrogate keys are BIGINT: an INTEGER key ends at 2.1 billion rows,
which a large claims history passes.  Date keys stay INTEGER (yyyymmdd).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The files a delivery consists of, and the header line each must carry.
FILE_ENTITY = {
    "claimants.csv": "claimants",
    "claims_v1.csv": "claims",
    "claims_v2.csv": "claims",
    "employers.csv": "employers",
    "payments.csv": "payments",
    "policies.csv": "policies",
}
FILE_HEADERS = {
    "claimants.csv": "claimant_id,first_name,last_name,date_of_birth,gender,employment_start_date,"
    "employer_id,created_at,updated_at",
    "employers.csv": "employer_id,company_name,industry,location,policy_id,created_at,updated_at",
    "payments.csv": "payment_id,claim_id,payment_date,payment_amount,payment_type,created_at",
    "policies.csv": "policy_id,policy_number,coverage_type,start_date,end_date,premium_amount,"
    "created_at,updated_at",
    "claims_v1.csv": "claim_id,claimant_id,policy_id,incident_date,report_date,claim_type,"
    "claim_status,claim_amount,approved_amount,created_at,updated_at",
    "claims_v2.csv": "claim_id,claimant_id,policy_id,incident_date,report_date,claim_type,"
    "claim_status,claim_amount,approved_amount,created_at,updated_at,claim_severity",
}

ENTITIES = ("claimants", "claims", "employers", "payments", "policies")

_INT = T.IntegerType()
_LONG = T.LongType()
_DATE = T.DateType()
_TIME = T.TimestampNTZType()
_BOOL = T.BooleanType()
_FLOAT = T.DoubleType()
_MONEY = T.DecimalType(12, 2)
_TEXT = T.StringType()


@dataclass(frozen=True)
class Varchar:
    """Text with a length limit; the limit is checked when a table is loaded."""

    max_length: int


def _table(required: tuple[str, ...] = (), **columns) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        limit = {"max_length": kind.max_length} if isinstance(kind, Varchar) else {}
        schema.add(name, _TEXT if limit else kind, name not in required, limit)
    return schema


_VALIDITY = {"effective_from": _DATE, "effective_to": _DATE, "is_current": _BOOL}

STAGING = {
    "claimants": _table(
        required=("claimant_id",),
        claimant_id=_LONG,
        first_name=Varchar(100),
        last_name=Varchar(100),
        date_of_birth=_DATE,
        gender=Varchar(10),
        employment_start_date=_DATE,
        employer_id=_LONG,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
    "claims": _table(
        required=("claim_id",),
        claim_id=_LONG,
        claimant_id=_LONG,
        policy_id=_LONG,
        incident_date=_DATE,
        report_date=_DATE,
        claim_type=Varchar(50),
        claim_status=Varchar(50),
        claim_amount=_FLOAT,
        approved_amount=_FLOAT,
        created_at=_TIME,
        updated_at=_TIME,
        claim_severity=Varchar(20),
    ),
    "employers": _table(
        required=("employer_id",),
        employer_id=_LONG,
        company_name=Varchar(200),
        industry=Varchar(100),
        location=Varchar(200),
        policy_id=_LONG,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
    "payments": _table(
        required=("payment_id",),
        payment_id=_LONG,
        claim_id=_LONG,
        payment_date=_DATE,
        payment_amount=_FLOAT,
        payment_type=Varchar(50),
        created_at=_TIME,
    ),
    "policies": _table(
        required=("policy_id",),
        policy_id=_LONG,
        policy_number=Varchar(50),
        coverage_type=Varchar(50),
        start_date=_DATE,
        end_date=_DATE,
        premium_amount=_FLOAT,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
}

WAREHOUSE = {
    "dim_date": _table(
        required=(
            "date_key", "full_date", "year", "quarter", "month", "month_name",
            "day_of_month", "day_of_week", "day_name", "is_weekend", "is_month_end",
        ),
        date_key=_INT,
        full_date=_DATE,
        year=_INT,
        quarter=_INT,
        month=_INT,
        month_name=Varchar(20),
        day_of_month=_INT,
        day_of_week=_INT,
        day_name=Varchar(20),
        is_weekend=_BOOL,
        is_month_end=_BOOL,
    ),
    "dim_claimant": _table(
        required=("claimant_key", "claimant_id", "effective_from", "is_current"),
        claimant_key=_LONG,
        claimant_id=_LONG,
        first_name=Varchar(100),
        last_name=Varchar(100),
        date_of_birth=_DATE,
        gender=Varchar(10),
        employment_start_date=_DATE,
        employer_id=_LONG,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
    "dim_employer": _table(
        required=("employer_key", "employer_id", "effective_from", "is_current"),
        employer_key=_LONG,
        employer_id=_LONG,
        company_name=Varchar(200),
        industry=Varchar(100),
        location=Varchar(200),
        policy_id=_LONG,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
    "dim_policy": _table(
        required=("policy_key", "policy_id", "effective_from", "is_current"),
        policy_key=_LONG,
        policy_id=_LONG,
        policy_number=Varchar(50),
        coverage_type=Varchar(50),
        start_date=_DATE,
        end_date=_DATE,
        premium_amount=_MONEY,
        created_at=_TIME,
        updated_at=_TIME,
        **_VALIDITY,
    ),
    "fact_claim": _table(
        required=("claim_key", "claim_id"),
        claim_key=_LONG,
        claim_id=_LONG,
        claimant_key=_LONG,
        policy_key=_LONG,
        employer_key=_LONG,
        incident_date_key=_INT,
        report_date_key=_INT,
        claim_type=Varchar(50),
        claim_status=Varchar(50),
        claim_severity=Varchar(20),
        claim_amount=_MONEY,
        approved_amount=_MONEY,
    ),
    "fact_payment": _table(
        required=("payment_key", "payment_id"),
        payment_key=_LONG,
        payment_id=_LONG,
        claim_key=_LONG,
        payment_date_key=_INT,
        payment_amount=_MONEY,
        payment_type=Varchar(50),
    ),
    "schema_evolution_log": _table(
        required=("log_id", "entity", "detection_date"),
        log_id=_LONG,
        entity=Varchar(100),
        detection_date=_DATE,
        previous_version=Varchar(20),
        current_version=Varchar(20),
        previous_columns=_TEXT,
        current_columns=_TEXT,
        added_columns=_TEXT,
        removed_columns=_TEXT,
    ),
}

# The columns rows of a table are sorted by.
SORT_COLUMNS = {
    "dim_date": ["full_date"],
    "dim_claimant": ["claimant_id", "effective_from"],
    "dim_employer": ["employer_id", "effective_from"],
    "dim_policy": ["policy_id", "effective_from"],
    "fact_claim": ["incident_date_key"],
    "fact_payment": ["payment_date_key"],
    "schema_evolution_log": ["entity", "detection_date"],
}

# Facts are dealt out to files by ranges of these: the sort column, then one that tells equal ones apart.
CLUSTER_COLUMNS = {
    "fact_claim": ["incident_date_key", "claim_id"],
    "fact_payment": ["payment_date_key", "payment_id"],
}


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so joins with it vanish."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nothing).filter(F.lit(False))


@dataclass(frozen=True)
class Dimension:
    """A slowly changing dimension: a change in a tracked attribute opens a new version."""

    name: str
    entity: str
    natural_key: str
    surrogate_key: str
    tracked: tuple[str, ...]
    added: tuple[T.StructField, ...] = ()  # attributes beside the declared ones

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*WAREHOUSE[self.name].fields, *self.added])

    @property
    def staging(self) -> T.StructType:
        """The staged columns a load takes its versions from."""
        staged = STAGING[self.entity]
        return T.StructType([*staged.fields, *[f for f in self.added if f.name not in staged.fieldNames()]])

    @property
    def attributes(self) -> list[str]:
        """Columns taken over from the staged version as they are."""
        own = {self.surrogate_key, *_VALIDITY}
        return [c for c in self.schema.fieldNames() if c not in own]


CLAIMANT = Dimension("dim_claimant", "claimants", "claimant_id", "claimant_key", ("gender", "employer_id"))
POLICY = Dimension("dim_policy", "policies", "policy_id", "policy_key", ("coverage_type",))
EMPLOYER = Dimension("dim_employer", "employers", "employer_id", "employer_key", ("industry", "location"))
DIMENSIONS = (CLAIMANT, POLICY, EMPLOYER)
