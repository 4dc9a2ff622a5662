"""The registered queries in SQL, independent of the Spark code."""

from __future__ import annotations

import datetime

import fixture_sql as fx

DAY1 = datetime.date(2024, 1, 31)
DAY2 = datetime.date(2024, 2, 1)

_D1, _D2 = f"DATE '{DAY1}'", f"DATE '{DAY2}'"


def _with(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes.items()) + "\n" + body


def _sources(*names: str) -> dict[str, str]:
    return {name: fx.SOURCES[name] for name in names}


# Entities -------------------------------------------------------------------------

_RANKED = "row_number() OVER (PARTITION BY {key} ORDER BY updated_at DESC NULLS LAST) = 1 AS is_current"

ENTITY_SELECT = {
    "claimants": """
        SELECT claimant_id, trim(first_name) AS first_name, trim(last_name) AS last_name, date_of_birth,
               COALESCE(trim(gender), 'Unknown') AS gender, employment_start_date, employer_id,
               created_at, updated_at, CAST(created_at AS DATE) AS effective_from,
               CAST(NULL AS DATE) AS effective_to, """ + _RANKED.format(key="claimant_id"),
    "employers": """
        SELECT employer_id, trim(company_name) AS company_name, industry, location, policy_id,
               created_at, updated_at, CAST(created_at AS DATE) AS effective_from,
               CAST(NULL AS DATE) AS effective_to, """ + _RANKED.format(key="employer_id"),
    "policies": """
        SELECT policy_id, policy_number, coverage_type, start_date, end_date, premium_amount,
               created_at, updated_at, start_date AS effective_from, end_date AS effective_to, """
    + _RANKED.format(key="policy_id"),
}


def _entity(name: str, source: str | None = None) -> str:
    return f"{ENTITY_SELECT[name]} FROM {source or name}"


_ALL_CLAIMS = """
    SELECT claim_id, claimant_id, policy_id, incident_date, report_date, claim_type,
           lower(trim(claim_status)) AS claim_status, claim_severity, claim_amount,
           COALESCE(approved_amount, 0.0) AS approved_amount, created_at, updated_at
    FROM (SELECT * FROM claims_v2
          UNION ALL
          SELECT *, 'unknown' AS claim_severity FROM claims_v1 a
          WHERE NOT EXISTS (SELECT 1 FROM claims_v2 b WHERE b.claim_id = a.claim_id)) u"""

_PAYMENTS = """
    SELECT payment_id, claim_id, payment_date, payment_amount, payment_type, created_at
    FROM (SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY created_at DESC NULLS LAST,
                 claim_id, payment_date, payment_amount, payment_type) AS n FROM payments) p
    WHERE n = 1"""

_CLAIM_SOURCES = _sources("claims_v1", "claims_v2")

# Dimensions -----------------------------------------------------------------------

# name: (entity, natural key, attributes taken over, tracked attributes)
DIMS = {
    "claimant": (
        "claimants",
        "claimant_id",
        ["claimant_id", "first_name", "last_name", "date_of_birth", "gender", "employment_start_date",
         "employer_id", "created_at", "updated_at"],
        ["gender", "employer_id"],
    ),
    "policy": (
        "policies",
        "policy_id",
        ["policy_id", "policy_number", "coverage_type", "start_date", "end_date", "premium_amount",
         "created_at", "updated_at"],
        ["coverage_type"],
    ),
    "employer": (
        "employers",
        "employer_id",
        ["employer_id", "company_name", "industry", "location", "policy_id", "created_at", "updated_at"],
        ["industry", "location"],
    ),
}


def _attributes(dim: str, alias: str) -> str:
    return ", ".join(
        f"CAST(CAST({alias}.{c} AS DECIMAL(12,2)) AS DOUBLE) AS {c}" if c == "premium_amount" else f"{alias}.{c}"
        for c in DIMS[dim][2]
    )


def _first_load(dim: str, staged: str) -> str:
    key = DIMS[dim][1]
    return f"""
        SELECT row_number() OVER (ORDER BY {key}) AS {dim}_key, {_attributes(dim, 's')},
               effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
        FROM {staged} s WHERE is_current"""


def _second_load(dim: str) -> dict[str, str]:
    """CTEs dim_after and its parts, by expiring rows and inserting twice."""
    entity, key, attributes, tracked = DIMS[dim]
    differs = " OR ".join(f"d.{c} <> s.{c}" for c in tracked)
    kept = ", ".join(f"d.{c}" for c in attributes)
    return {
        **_sources(entity),
        "day1": fx.DAYS[(entity, 1)].replace(f"FROM {entity}", f"FROM {entity} AS x"),
        "day2": fx.DAYS[(entity, 2)].replace(f"FROM {entity}", f"FROM {entity} AS x"),
        "staged1": _entity(entity, "day1"),
        "staged2": _entity(entity, "day2"),
        "dim": _first_load(dim, "staged1"),
        "differing": f"""SELECT DISTINCT d.{dim}_key AS k FROM dim d JOIN staged2 s ON d.{key} = s.{key}
                         WHERE d.is_current AND ({differs})""",
        "after_expiry": f"""
            SELECT d.{dim}_key, {kept}, d.effective_from,
                   CASE WHEN k IS NULL THEN d.effective_to ELSE {_D2} - 1 END AS effective_to,
                   k IS NULL AND d.is_current AS is_current, k IS NOT NULL AS just_closed
            FROM dim d LEFT JOIN differing ON d.{dim}_key = k""",
        "brand_new": f"""
            SELECT {_attributes(dim, 's')}, COALESCE(s.effective_from, {_D2}) AS effective_from,
                   CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
            FROM staged2 s WHERE s.is_current AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.{key} = s.{key})""",
        "changed": f"""
            SELECT {_attributes(dim, 's')}, {_D2} AS effective_from,
                   CAST(NULL AS DATE) AS effective_to, TRUE AS is_current
            FROM staged2 s WHERE s.is_current
              AND EXISTS (SELECT 1 FROM dim d WHERE d.{key} = s.{key})
              AND NOT EXISTS (SELECT 1 FROM after_expiry a WHERE a.{key} = s.{key} AND a.is_current)""",
        "inserted": "SELECT * FROM brand_new UNION ALL SELECT * FROM changed",
        "dim_after": f"""
            SELECT * EXCLUDE (just_closed) FROM after_expiry
            UNION ALL
            SELECT (SELECT max({dim}_key) FROM dim) + row_number() OVER (ORDER BY {key}), * FROM inserted""",
    }


def _scoped(dim: str) -> dict[str, str]:
    """The CTEs of one dimension as a single one, dim_<name>, for use side by side."""
    return {f"dim_{dim}": _with(_second_load(dim), "SELECT * FROM dim_after")}


# Facts and views ------------------------------------------------------------------


def _date_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


_FACT_CLAIM = f"""
    SELECT row_number() OVER (ORDER BY c.claim_id) AS claim_key, c.claim_id, dc.claimant_key, dp.policy_key,
           de.employer_key, {_date_key('c.incident_date')} AS incident_date_key,
           {_date_key('c.report_date')} AS report_date_key, c.claim_type, c.claim_status, c.claim_severity,
           CAST(c.claim_amount AS DECIMAL(12,2)) AS claim_amount,
           CAST(c.approved_amount AS DECIMAL(12,2)) AS approved_amount
    FROM all_claims c
    JOIN dim_claimant dc ON dc.claimant_id = c.claimant_id AND dc.is_current
    JOIN dim_policy dp ON dp.policy_id = c.policy_id AND dp.is_current
    JOIN dim_employer de ON de.employer_id = dc.employer_id AND de.is_current
    WHERE c.policy_id IS NOT NULL"""

_FACT_PAYMENT = f"""
    SELECT row_number() OVER (ORDER BY p.payment_id) AS payment_key, p.payment_id, f.claim_key,
           {_date_key('p.payment_date')} AS payment_date_key,
           CAST(p.payment_amount AS DECIMAL(12,2)) AS payment_amount, p.payment_type
    FROM unique_payments p JOIN fact_claim f ON f.claim_id = p.claim_id"""

# avg = sum / count, rounded half up to six digits, in whole numbers (amounts are positive)
_SUMMARY = """
    SELECT de.company_name, de.industry, dp.coverage_type, fc.claim_type, fc.claim_status, fc.claim_severity,
           COUNT(*) AS total_claims,
           CAST(SUM(fc.claim_amount) AS DOUBLE) AS total_claimed,
           CAST(SUM(fc.approved_amount) AS DOUBLE) AS total_approved,
           CAST((CAST(SUM(fc.claim_amount) * 100 AS HUGEINT) * 20000 + COUNT(fc.claim_amount))
                // (2 * COUNT(fc.claim_amount)) AS DOUBLE) / 1000000.0 AS avg_claim_amount
    FROM fact_claim fc
    JOIN dim_employer de ON fc.employer_key = de.employer_key AND de.is_current
    JOIN dim_policy dp ON fc.policy_key = dp.policy_key AND dp.is_current
    GROUP BY 1, 2, 3, 4, 5, 6"""

_CALENDAR = f"""
    SELECT {_date_key('d')} AS date_key, CAST(d AS DATE) AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
           CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
           dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend, d = last_day(d) AS is_month_end
    FROM (SELECT unnest(range(DATE '2020-01-01', DATE '2031-01-01', INTERVAL 1 DAY)) AS d) days"""


def _star() -> dict[str, str]:
    ctes = _sources("claimants", "employers", "policies", "claims_v1", "claims_v2", "payments")
    for dim, (entity, *_) in DIMS.items():
        ctes[f"staged_{entity}"] = _entity(entity)
        ctes[f"dim_{dim}"] = _first_load(dim, f"staged_{entity}")
    return {**ctes, "all_claims": _ALL_CLAIMS, "fact_claim": _FACT_CLAIM, "unique_payments": _PAYMENTS}


_FACT_CLAIM_PLAIN = """
    SELECT * REPLACE (CAST(claim_amount AS DOUBLE) AS claim_amount, CAST(approved_amount AS DOUBLE) AS approved_amount)
    FROM fact_claim"""


def _check(name: str, passed: str, value: str, expected: str, source: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS result,
               CAST({value} AS BIGINT) AS value, CAST({expected} AS BIGINT) AS expected FROM {source}"""


def _quality(p: str = "", floor: int = 2000, more: dict[str, str] | None = None) -> str:
    """The checks over the star, or over its tables as ``more`` has them under the prefix ``p``."""
    none = ("COUNT(*) = 0", "COUNT(*)", "0")
    checks = [
        _check("fact_claim PK uniqueness", "COUNT(*) = COUNT(DISTINCT claim_id)", "COUNT(*)",
               "COUNT(DISTINCT claim_id)", f"{p}fact_claim"),
        _check("fact_claim FK claimant_key", *none,
               f"{p}fact_claim f LEFT JOIN {p}dim_claimant d ON f.claimant_key = d.claimant_key "
               "WHERE d.claimant_key IS NULL AND f.claimant_key IS NOT NULL"),
        _check("fact_claim non-negative amounts", *none, f"{p}fact_claim WHERE claim_amount < 0 OR approved_amount < 0"),
        _check("fact_claim row count", f"COUNT(*) >= {floor}", "COUNT(*)", str(floor), f"{p}fact_claim"),
        _check("fact_claim valid date keys", *none,
               f"{p}fact_claim f LEFT JOIN dim_date d ON f.incident_date_key = d.date_key "
               "WHERE d.date_key IS NULL AND f.incident_date_key IS NOT NULL"),
        _check("claim_status standardized", *none, f"{p}fact_claim WHERE claim_status NOT IN ('open', 'closed', 'denied')"),
        _check("fact_payment FK claim_key", *none,
               f"{p}fact_payment y LEFT JOIN {p}fact_claim f ON y.claim_key = f.claim_key WHERE f.claim_key IS NULL"),
        _check("fact_claim no NULL claim_id", *none, f"{p}fact_claim WHERE claim_id IS NULL"),
        _check("dim_claimant no NULL claimant_id", *none, f"{p}dim_claimant WHERE claimant_id IS NULL"),
        _check("dim_policy no NULL policy_id", *none, f"{p}dim_policy WHERE policy_id IS NULL"),
    ]
    for dim, (_, key, *_) in DIMS.items():
        per_key = f"(SELECT {key}, COUNT(*) AS n FROM {p}dim_{dim} WHERE is_current GROUP BY {key}) t"
        checks.append(_check(f"dim_{dim} SCD2 integrity", "MAX(n) = 1", "MAX(n)", "1", per_key))
    ctes = {**_star(), "fact_payment": _FACT_PAYMENT, "dim_date": _CALENDAR, **(more or {})}
    return _with(ctes, " UNION ALL ".join(checks))


def _faulty_quality() -> str:
    replaced = {name: ", ".join(f"{sql} AS {c}" for c, sql in columns.items()) for name, columns in fx.FAULTS.items()}
    more = {}
    for name, again in fx.REPEATED.items():
        columns = f"* REPLACE ({replaced[name]})" if name in replaced else "*"
        more[f"bad_{name}"] = f"SELECT {columns} FROM {name} UNION ALL SELECT {columns} FROM {name} WHERE {again}"
    return _quality("bad_", 1_000_000_000, more)


# Repair ---------------------------------------------------------------------------

_GAPS = """
    starts AS (SELECT claimant_id, effective_from, MAX(COALESCE(effective_to, DATE '9999-12-31')) AS until_day
               FROM history GROUP BY 1, 2),
    walked AS (SELECT claimant_id, effective_from,
                      MAX(until_day) OVER (PARTITION BY claimant_id ORDER BY effective_from
                                           ROWS UNBOUNDED PRECEDING) AS covered,
                      LEAD(effective_from) OVER (PARTITION BY claimant_id ORDER BY effective_from) AS next_from
               FROM starts),
    ends AS (SELECT claimant_id, GREATEST(covered, effective_from - 1) AS covered, next_from FROM walked)
    SELECT claimant_id, covered + 1 AS gap_from, next_from - 1 AS gap_to, next_from - covered - 1 AS gap_days
    FROM ends WHERE next_from > covered + 1"""

_OVERLAPS = """
    SELECT a.claimant_id, a.claimant_key AS a_key, a.effective_from AS a_effective_from,
           a.effective_to AS a_effective_to, b.claimant_key AS b_key,
           b.effective_from AS b_effective_from, b.effective_to AS b_effective_to
    FROM history a JOIN history b
      ON a.claimant_id = b.claimant_id AND a.claimant_key <> b.claimant_key
     AND a.effective_from < b.effective_to AND a.effective_to > b.effective_from"""


def _closing(condition: str, day: str) -> str:
    return f"""
        SELECT claimant_key, claimant_id, gender, effective_from,
               CASE WHEN {condition} THEN {day} ELSE effective_to END AS effective_to,
               CASE WHEN {condition} THEN FALSE ELSE is_current END AS is_current
        FROM history"""


# Schema evolution -----------------------------------------------------------------


def _evolution() -> str:
    events = [
        ("claims", '["adjuster"]', "[]", f"(SELECT COUNT(*) FROM ({_ALL_CLAIMS}) c WHERE policy_id IS NOT NULL)"),
        ("payments", "[]", '["channel"]', f"(SELECT COUNT(*) FROM ({_PAYMENTS}) p)"),
        ("policies", '["agent"]', '["broker"]', "(SELECT COUNT(*) FROM policies)"),
    ]
    body = " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, {_D2} AS detection_date, '{DAY1}' AS previous_version, "
        f"'{DAY2}' AS current_version, '{added}' AS added_columns, '{removed}' AS removed_columns, "
        f"CAST({count} AS BIGINT) AS landed_rows"
        for entity, added, removed, count in events
    )
    return _with(_sources("claims_v1", "claims_v2", "payments", "policies"), body)


def _log_after_two_days() -> str:
    names = ("payment_id", "claim_id", "payment_date", "payment_amount", "payment_type", "created_at")
    before = ", ".join(f'"{name}"' for name in names)
    return _with(
        _sources("payments"),
        f"""
        SELECT CAST(1 AS BIGINT) AS log_id, 'payments' AS entity, {_D2} AS detection_date,
               '{DAY1}' AS previous_version, '{DAY2}' AS current_version, '[{before}]' AS previous_columns,
               '[{before}, "currency"]' AS current_columns, '["currency"]' AS added_columns,
               '[]' AS removed_columns, COUNT(*) AS landed_rows
        FROM ({_PAYMENTS}) p""",
    )


def _added_column() -> str:
    body = " UNION ALL ".join(
        f"SELECT payment_type, {currency} AS currency, COUNT(*) AS payments, {day} AS published "
        f"FROM ({_PAYMENTS}) p GROUP BY payment_type"
        for currency, day in (("CAST(NULL AS VARCHAR)", _D1), ("'USD'", _D2))
    )
    return _with(_sources("payments"), body)


def _delivery() -> str:
    names = ("claimants", "claims_v1", "claims_v2", "employers", "payments", "policies")
    body = " UNION ALL ".join(
        f"SELECT '{n}.csv' AS name, '{n.split('_')[0]}' AS entity, TRUE AS intact, "
        f"'{'currency' if n == 'payments' else ''}' AS new_columns, COUNT(*) AS rows FROM {n}"
        for n in names
    )
    return _with(_sources(*names), body)


def _after_two_days() -> dict[str, str]:
    """The CTEs of the claims as the second of two daily runs leaves them."""
    return {
        **_CLAIM_SOURCES,
        **_scoped("claimant"),
        **_scoped("policy"),
        **_scoped("employer"),
        "all_claims": _ALL_CLAIMS,
        "fact_claim": _FACT_CLAIM,
    }


def _fact_files() -> str:
    body = " UNION ALL ".join(
        f"SELECT '{name}' AS name, COUNT(*) AS rows, MIN({day}) AS first_day, MAX({day}) AS last_day, "
        "CAST(0 AS BIGINT) AS overlapping_files, TRUE AS within_limit, "
        f"COUNT(*) FILTER ({day} BETWEEN 20220601 AND 20220630) AS month_rows FROM {name}"
        for name, day in (("fact_claim", "incident_date_key"), ("fact_payment", "payment_date_key"))
    )
    ctes = {**_sources("payments"), **_after_two_days(), "unique_payments": _PAYMENTS, "fact_payment": _FACT_PAYMENT}
    return _with(ctes, body)


def _quarantine() -> str:
    fault = (
        "CASE WHEN claim_id % 50 IN (0, 1) THEN 'not as many fields as the header' "
        "WHEN claim_id % 50 = 2 THEN 'no readable key' ELSE 'none' END"
    )
    return _with(
        _sources("payments"),
        "SELECT 'payments' AS entity, fault, CASE fault WHEN 'none' THEN COUNT(DISTINCT payment_id) ELSE COUNT(*) END "
        f"AS lines FROM (SELECT payment_id, {fault} AS fault FROM payments) p GROUP BY fault",
    )


def _dim_added_column() -> str:
    return _with(
        _second_load("claimant"),
        "SELECT claimant_key, claimant_id, CASE WHEN claimant_key > (SELECT max(claimant_key) FROM dim) "
        "THEN concat('c', claimant_id, '@x') END AS email, is_current FROM dim_after",
    )


def _dropped_column() -> str:
    body = " UNION ALL ".join(
        f"SELECT '{name}' AS name, {day} AS published, COUNT(*) AS rows, FALSE AS shows_column FROM ({rows}) t"
        for name, rows in (("staging.stg_payments", _PAYMENTS), ("warehouse.dim_policy", "SELECT * FROM dim_policy"))
        for day in (_D1, _D2)
    )
    return _with({**_sources("payments"), **_scoped("policy")}, body)


def _landed(entity: str, day: int) -> str:
    """Rows of an entity as landed on a day."""
    if entity == "payments":
        return f"({_PAYMENTS})"
    if entity == "claims":
        return f"({_ALL_CLAIMS} WHERE policy_id IS NOT NULL)"
    return f"({fx.DAYS[(entity, day)].replace(f'FROM {entity}', f'FROM {entity} AS x')})"


_ENTITY_NAMES = ("claimants", "claims", "employers", "payments", "policies")
_ALL_SOURCES = _sources("claimants", "claims_v1", "claims_v2", "employers", "payments", "policies")


def _landing_by_date() -> str:
    body = " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, {day} AS ingestion_date, COUNT(*) AS rows, "
        f"{'COUNT(*)' if (entity, k) == ('payments', 2) else 'CAST(0 AS BIGINT)'} AS with_currency "
        f"FROM {_landed(entity, k)} t"
        for entity in _ENTITY_NAMES
        for k, day in ((1, _D1), (2, _D2))
    )
    return _with(_ALL_SOURCES, body)


def _columns_as_of() -> str:
    policies = (
        "policy_id policy_number coverage_type start_date end_date premium_amount created_at updated_at "
        "effective_from effective_to is_current"
    ).split()
    payments = "payment_id claim_id payment_date payment_amount payment_type created_at".split()
    last = DAY2 + datetime.timedelta(days=9)
    body = " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{as_of}' AS as_of, '{','.join(sorted(columns + more))}' AS columns, "
        f"DATE '{day}' AS on_day, COUNT(*) AS landed_rows FROM {_landed(entity, 1 if as_of == DAY1 else 2)} t"
        for entity, columns, new in (("payments", payments, ["currency"]), ("policies", policies, []))
        for day, as_of, more in ((DAY1, DAY1, []), (DAY2, DAY2, new), (last, DAY2, new))
    )
    return _with(_sources("payments", "policies"), body)


def _run_counts() -> str:
    """Landed rows of both days; placed rows by the dimensions as each day leaves them."""
    parts = [
        f"SELECT {day} AS day, 'landed {entity}' AS counted, COUNT(*) AS rows FROM {_landed(entity, day)} t"
        for day in (1, 2)
        for entity in _ENTITY_NAMES
    ]
    no_policy = f"SELECT COUNT(*) FROM ({_ALL_CLAIMS} WHERE policy_id IS NULL) t"
    ctes = {**_ALL_SOURCES, "all_claims": _ALL_CLAIMS, "unique_payments": _PAYMENTS}
    for day in (1, 2):
        parts.append(f"SELECT {day}, 'claims without policy', ({no_policy})")
        for dim in DIMS:
            loads = _second_load(dim)
            text = "SELECT * FROM dim_after" if day == 2 else "SELECT * FROM dim"
            ctes[f"day{day}_{dim}"] = _with(loads, text)
        placed = _FACT_CLAIM
        for dim in DIMS:
            placed = placed.replace(f"JOIN dim_{dim} ", f"JOIN day{day}_{dim} ")
        ctes[f"placed{day}"] = placed
        parts.append(f"SELECT {day}, 'placed fact_claim', COUNT(*) FROM placed{day}")
        paid = f"unique_payments p JOIN placed{day} f ON f.claim_id = p.claim_id"
        parts.append(f"SELECT {day}, 'placed fact_payment', COUNT(*) FROM {paid}")
    return _with(ctes, " UNION ALL ".join(parts))


def _missing_columns() -> str:
    return _with(
        _sources("payments"),
        "SELECT payment_id, claim_id, payment_date, CAST(NULL AS DOUBLE) AS payment_amount, "
        "CAST(NULL AS VARCHAR) AS payment_type, created_at FROM (SELECT *, row_number() OVER (PARTITION BY payment_id "
        "ORDER BY created_at DESC NULLS LAST, claim_id, payment_date) AS n FROM payments) p WHERE n = 1",
    )


def _run_outcomes() -> str:
    checks = _quality(floor=10**9)
    fixed = {
        "no inbox": "inbox is required: the folder the delivery lies in",
        "broken delivery": "extraction failed: payments.csv: missing columns [''claim_id'']",
        "run ids": f"000001_{DAY1}_{DAY1}, 000002_backfill, 000002_{DAY2}_{DAY2}",
    }
    body = " UNION ALL ".join(f"SELECT '{case}' AS case_name, '{text}' AS outcome" for case, text in fixed.items())
    # The error names the checks in the order of the report, here always one or two.
    for case in ("whole run", "kept failures"):
        body += f" UNION ALL SELECT '{case}', string_agg(check_name, ', ' ORDER BY check_name) FROM failed"
    body += " UNION ALL SELECT 'claims loaded', value::VARCHAR FROM checks WHERE check_name = 'fact_claim row count'"
    return _with({"checks": checks, "failed": "SELECT check_name FROM checks WHERE result = 'FAIL'"}, body)


def _check_trend() -> str:
    runs = ((1, _D1, _quality(floor=1)), (2, _D2, _faulty_quality()), (3, _D2, _quality(floor=10**9)))
    history = " UNION ALL ".join(f"SELECT '{run}' AS run, {day} AS checked_on, * FROM ({text}) t" for run, day, text in runs)
    return _with(
        {
            "history": history,
            "counted": "SELECT *, lag(value) OVER (PARTITION BY check_name ORDER BY run) AS previous_value, "
            "sum((result = 'PASS')::INT) OVER (PARTITION BY check_name ORDER BY run) AS passes FROM history",
        },
        "SELECT * EXCLUDE (passes), value - previous_value AS change, CAST(sum((result <> 'PASS')::INT) "
        "OVER (PARTITION BY check_name, passes ORDER BY run) AS BIGINT) AS failures_in_a_row FROM counted",
    )


def statements() -> dict[str, str]:
    history = _sources("history")
    latest = "row_number() OVER (PARTITION BY claimant_id ORDER BY effective_from DESC, claimant_key DESC)"
    sql = {
        "claims_unified": _with(_CLAIM_SOURCES, _ALL_CLAIMS + " WHERE policy_id IS NOT NULL"),
        "claims_dropped": _with(
            {**_CLAIM_SOURCES, "all_claims": _ALL_CLAIMS},
            "SELECT claim_severity, COUNT(*) AS claims, COUNT(*) FILTER (WHERE policy_id IS NULL) AS without_policy "
            "FROM all_claims GROUP BY 1",
        ),
        "claimants_versions": _with(_sources("claimants"), _entity("claimants")),
        "employers_versions": _with(_sources("employers"), _entity("employers")),
        "policies_versions": _with(_sources("policies"), _entity("policies")),
        "payments_dedup": _with(_sources("payments"), _PAYMENTS),
        "dim_date": _with(
            {**_CLAIM_SOURCES, "all_claims": _ALL_CLAIMS, "calendar": _CALENDAR},
            "SELECT c.*, (SELECT COUNT(*) FROM all_claims a WHERE a.incident_date = c.full_date) AS incidents "
            "FROM calendar c",
        ),
        "surrogate_keys": _with(
            {**_sources("payments"), "unique_payments": _PAYMENTS},
            "SELECT 1000 + row_number() OVER (ORDER BY payment_id) AS payment_key, payment_id, claim_id "
            "FROM unique_payments",
        ),
        "fact_claim": _with(_star(), _FACT_CLAIM_PLAIN),
        "fact_payment": _with(
            {**_star(), "fact_payment": _FACT_PAYMENT},
            "SELECT * REPLACE (CAST(payment_amount AS DOUBLE) AS payment_amount) FROM fact_payment",
        ),
        "claims_summary": _with(_star(), _SUMMARY),
        "fact_claim_loaded": _with(_star(), f"SELECT * EXCLUDE (claim_key) FROM ({_FACT_CLAIM_PLAIN}) AS f"),
        "fact_payment_loaded": _with(
            {**_star(), "fact_payment": _FACT_PAYMENT},
            "SELECT y.* EXCLUDE (payment_key, claim_key) REPLACE (CAST(payment_amount AS DOUBLE) AS payment_amount), "
            "f.claim_id FROM fact_payment y JOIN fact_claim f ON y.claim_key = f.claim_key",
        ),
        "quality_report": _quality(),
        "quality_faults": _faulty_quality(),
        "scd2_duplicates": _with(
            history,
            "SELECT claimant_id, COUNT(*) AS current_count FROM history WHERE is_current "
            "GROUP BY claimant_id HAVING COUNT(*) > 1",
        ),
        "scd2_gaps": "WITH history AS (" + fx.SOURCES["history"] + "),\n" + _GAPS,
        "scd2_overlaps": _with(history, _OVERLAPS),
        "scd2_latest_version": _with(
            history,
            f"SELECT * EXCLUDE (n) FROM (SELECT *, {latest} AS n FROM history) h WHERE n = 1",
        ),
        "scd2_version_history": _with(
            history,
            "SELECT claimant_key, claimant_id, effective_from, effective_to, is_current FROM history "
            "ORDER BY claimant_id, effective_from, claimant_key",
        ),
        "scd2_close_key": _with(history, _closing("claimant_key = 101", _D2)),
        "scd2_close_natural": _with(history, _closing("claimant_id = 77 AND is_current", _D1)),
        "scd2_fix_attribute": _with(
            history,
            "SELECT * REPLACE (CASE WHEN claimant_key = 101 THEN 'corrected' ELSE gender END AS gender) FROM history",
        ),
        "scd2_repair_current": _with(
            {
                "raw_history": fx.SOURCES["history"],
                "open_rank": "SELECT claimant_key AS k, row_number() OVER (PARTITION BY claimant_id "
                "ORDER BY effective_from DESC, claimant_key DESC) AS n FROM raw_history WHERE is_current",
                "history": "SELECT h.*, COALESCE(n > 1, FALSE) AS surplus FROM raw_history h "
                "LEFT JOIN open_rank ON k = claimant_key",
            },
            _closing("surplus", _D2),
        ),
        "schema_evolution_history": _evolution(),
        "delivery_contract": _delivery(),
        "evolution_log": _log_after_two_days(),
        "added_column": _added_column(),
        "reject_top10": _with(
            _sources("claimants"),
            """
            SELECT claimant_id, updated_at, 'first_name is longer than 100' AS faults FROM claimants
            WHERE length(repeat(trim(first_name), CAST(1 + claimant_id % 7 AS INTEGER))) > 100
            ORDER BY updated_at DESC, claimant_id LIMIT 10""",
        ),
        "pipeline_claims_summary": _with(_after_two_days(), _SUMMARY),
        "fact_files": _fact_files(),
        "quarantine": _quarantine(),
        "dim_added_column": _dim_added_column(),
        "dropped_column": _dropped_column(),
        "landing_by_date": _landing_by_date(),
        "columns_as_of": _columns_as_of(),
        "run_counts": _run_counts(),
        "published_view": _with(_after_two_days(), _SUMMARY),
        "missing_columns": _missing_columns(),
        "check_trend": _check_trend(),
        "run_outcomes": _run_outcomes(),
    }
    parts = {"expired": "SELECT * EXCLUDE (just_closed) FROM after_expiry WHERE just_closed",
             "new": "SELECT * FROM brand_new", "changed": "SELECT * FROM changed"}
    for dim in DIMS:
        ctes = _second_load(dim)
        sql[f"scd2_merge_{dim}"] = _with(ctes, "SELECT * FROM dim_after")
        for step, body in parts.items():
            sql[f"scd2_{step}_{dim}"] = _with(ctes, body)
    return sql
