"""The same results as plain SQL over the given tables, for an independent check."""

from __future__ import annotations

from cohortlens.operators.alerts import ADVICE

# Raw tables: the derivation rules of FIXTURES.md.
RAW = """
base AS (
  SELECT c_custkey AS k, 'S' || CAST(100000 + c_custkey AS VARCHAR) AS student_id,
         c_acctbal, c_mktsegment, c_nationkey
  FROM customer),
oc AS (
  SELECT o_custkey, count(DISTINCT o_orderdate) AS nd,
         count(*) FILTER (o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) AS nf,
         max(o_orderdate) AS lastd
  FROM orders GROUP BY o_custkey),
raw_students AS (
  SELECT student_id,
         CASE WHEN k % 33 = 0 THEN NULL WHEN k % 29 = 0 THEN 'Other'
              WHEN k % 2 = 0 THEN ' Male ' ELSE 'Female' END AS gender,
         CASE WHEN k % 12 = 0 THEN lower(r_name) ELSE r_name END AS region,
         n_name AS school_id,
         CAST(CASE WHEN k % 50 = 1 THEN 15 ELSE 6 + k % 7 END AS INTEGER) AS grade_level,
         CAST(2014 + k % 10 AS INTEGER) AS enrollment_year,
         lower(c_mktsegment) AS program_type
  FROM base JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_academic AS (
  SELECT student_id,
         CASE WHEN k % 20 = 1 THEN NULL WHEN k % 97 = 0 THEN 120.0::DOUBLE
              ELSE floor(c_acctbal)::DOUBLE / 100 END AS avg_score,
         CAST(CASE WHEN k % 40 = 3 THEN NULL ELSE nf END AS INTEGER) AS failed_subjects
  FROM base LEFT JOIN oc ON k = o_custkey),
raw_attendance AS (
  SELECT student_id,
         CAST(CASE WHEN k % 61 = 5 THEN NULL WHEN k % 60 = 0 THEN 0 ELSE 180 END AS INTEGER) AS total_days,
         CAST(CASE WHEN k % 25 = 2 THEN NULL ELSE nd * 14 END AS INTEGER) AS days_present
  FROM base LEFT JOIN oc ON k = o_custkey),
raw_socio AS (
  SELECT student_id,
         CASE WHEN k % 17 = 0 THEN NULL WHEN c_acctbal < 3000 THEN ' Low'
              WHEN c_acctbal < 7000 THEN 'Middle' ELSE 'High' END AS family_income_band,
         CASE k % 23 WHEN 0 THEN NULL WHEN 1 THEN 'Unknown Level' ELSE ' Graduate ' END AS parental_education,
         CASE k % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN ' YES' WHEN 2 THEN 'true' WHEN 3 THEN NULL ELSE 'No' END
           AS access_to_internet,
         CASE k % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'True' ELSE 'False' END AS working_part_time,
         CASE k % 5 WHEN 0 THEN 'Y' WHEN 1 THEN '1' WHEN 2 THEN 't' ELSE 'False' END AS scholarship_status
  FROM base),
raw_retention AS (
  SELECT student_id,
         CASE WHEN k % 50 = 7 THEN NULL ELSE lastd < TIMESTAMP '2000-11-01 00:00:00' END AS dropout_flag,
         CASE WHEN k % 3 = 0 THEN NULL ELSE 'Financial Issues' END AS dropout_reason,
         CASE WHEN k % 4 = 0 THEN 'Dropped' ELSE 'Retained' END AS retention_status
  FROM base LEFT JOIN oc ON k = o_custkey)
"""


def _academic(name: str, mean: str) -> str:
    return f"""
{name}_scores AS (
  SELECT student_id,
         CASE WHEN avg_score IS NULL OR avg_score < 0 THEN ({mean})
              WHEN avg_score > 100 THEN 100.0::DOUBLE ELSE avg_score END AS avg_score,
         CASE WHEN failed_subjects < 0 THEN 0 WHEN failed_subjects > 6 THEN 6
              ELSE failed_subjects END AS failed_subjects
  FROM raw_academic),
{name} AS (
  SELECT *, coalesce(performance_score < 50 OR failed_subjects >= 3, false) AS academic_risk_flag
  FROM (SELECT *, round(avg_score - failed_subjects * 5, 2) AS performance_score FROM {name}_scores))
"""


def _attendance(name: str, bound: str) -> str:
    return f"""
{name} AS (
  SELECT *, coalesce(attendance_pct < 75, false) AS attendance_risk_flag
  FROM (
    SELECT *, round(days_present::DOUBLE / total_days * 100, 2) AS attendance_pct
    FROM (
      SELECT student_id,
             CASE WHEN total_days > 0 THEN total_days ELSE 180 END AS total_days,
             CASE WHEN days_present IS NULL OR days_present < 0 THEN 0
                  WHEN days_present > {bound} THEN {bound} ELSE days_present END AS days_present
      FROM raw_attendance)))
"""


SILVER = (
    """
s_students AS (
  SELECT trim(student_id) AS student_id,
         CASE WHEN trim(gender) IN ('Male', 'Female') THEN trim(gender) ELSE 'UNKNOWN' END AS gender,
         upper(trim(region)) AS region, trim(school_id) AS school_id, grade_level, enrollment_year,
         upper(trim(program_type)) AS program_type
  FROM raw_students
  WHERE grade_level BETWEEN 1 AND 12 AND enrollment_year >= 2015),
"""
    + _academic("s_academic", "SELECT avg(avg_score) FROM raw_academic")
    + ","
    + _attendance("s_attendance", "total_days")
    + """,
s_socio AS (
  SELECT *, family_income_band = 'LOW' OR working_part_time AS socio_economic_risk_flag
  FROM (
    SELECT student_id, coalesce(upper(trim(family_income_band)), 'UNKNOWN') AS family_income_band,
           trim(parental_education) AS parental_education,
           coalesce(trim(access_to_internet) IN ('Yes', 'YES', 'true'), false) AS access_to_internet,
           working_part_time IN ('Yes', 'True') AS working_part_time,
           scholarship_status = 'Y' AS scholarship_status
    FROM raw_socio)),
s_retention AS (
  SELECT student_id, dropped AS dropout_flag,
         CASE WHEN dropped THEN coalesce(dropout_reason, 'NOT REPORTED') ELSE 'N/A' END AS dropout_reason,
         CASE WHEN dropped THEN 'DROPPED' ELSE 'RETAINED' END AS retention_status,
         dropped AS retention_risk_flag
  FROM (SELECT student_id, dropout_reason, coalesce(dropout_flag, false) AS dropped FROM raw_retention))
"""
)

GOLD = """
flags AS (
  SELECT s.student_id, gender, region, school_id, grade_level, program_type,
         performance_score, academic_risk_flag, attendance_pct, attendance_risk_flag,
         socio_economic_risk_flag, retention_status, retention_risk_flag
  FROM s_students s
  LEFT JOIN s_academic a ON a.student_id = s.student_id
  LEFT JOIN s_attendance t ON t.student_id = s.student_id
  LEFT JOIN s_socio e ON e.student_id = s.student_id
  LEFT JOIN s_retention r ON r.student_id = s.student_id),
profile AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
         CASE WHEN socio_economic_risk_flag THEN 'SOCIO_ECONOMIC'
              WHEN attendance_risk_flag THEN 'ATTENDANCE'
              WHEN academic_risk_flag THEN 'ACADEMIC' END AS primary_risk_driver,
         risk_score >= 70 AS intervention_required
  FROM (
    SELECT *, CASE WHEN academic_risk_flag THEN 30 ELSE 0 END
            + CASE WHEN attendance_risk_flag THEN 40 ELSE 0 END
            + CASE WHEN socio_economic_risk_flag THEN 30 ELSE 0 END AS risk_score
    FROM flags)),
predictions AS (SELECT student_id, risk_score::DOUBLE / 100 AS dropout_probability FROM profile),
alerts AS (SELECT * FROM predictions WHERE dropout_probability >= 0.7)
"""

FEATURES = """
features AS (
  SELECT * FROM (
    SELECT student_id, attendance_pct::DOUBLE AS attendance_pct, performance_score::DOUBLE AS performance_score,
           risk_score::DOUBLE AS risk_score, grade_level,
           CASE WHEN academic_risk_flag THEN 1 ELSE 0 END AS academic_risk_flag,
           CASE WHEN attendance_risk_flag THEN 1 ELSE 0 END AS attendance_risk_flag,
           CASE WHEN socio_economic_risk_flag THEN 1 ELSE 0 END AS socio_economic_risk_flag,
           CASE WHEN retention_risk_flag THEN 1 ELSE 0 END AS label
    FROM profile)
  WHERE attendance_pct IS NOT NULL AND performance_score IS NOT NULL AND grade_level IS NOT NULL)
"""


def _bucket(salt: str) -> str:
    return f"(('0x' || substr(md5(student_id || ':{salt}'), 1, 8))::BIGINT % 10000)"


# Terms of the model that no other term repeats: the risk score is a sum of the flags.
_TERMS = ["1.0", "attendance_pct / 100", "performance_score / 100", "grade_level / 10.0", "academic_risk_flag", "attendance_risk_flag", "socio_economic_risk_flag"]
_NEWTON_STEPS = 8


def _newton() -> str:
    """The fitted logistic regression by Newton's method: CTEs up to ``beta``, one row with b0, b1, ..."""
    k = range(len(_TERMS))
    line = " + ".join(f"b{i} * x{i}" for i in k)
    terms = ", ".join(f"({t})::DOUBLE AS x{i}" for i, t in enumerate(_TERMS))
    out = [
        f"x AS MATERIALIZED (SELECT student_id, label, {_bucket('42')} < 8000 AS is_train, {terms} FROM features)",
        "beta_0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in k) + ")",
    ]
    for step in range(_NEWTON_STEPS):
        sums = [f"sum(p * (1 - p) * x{i} * x{j}) AS a{i}_{j}" for i in k for j in k]
        sums += [f"sum(x{i} * (label - p)) AS r{i}" for i in k]
        rows = f"SELECT x.*, 1 / (1 + exp(-({line}))) AS p FROM x, beta_{step} WHERE is_train"
        out.append(f"system_{step}_0 AS MATERIALIZED (SELECT {', '.join(sums)} FROM ({rows}))")
        for v in k:  # eliminate variable v from all other equations
            cells = []
            for i in k:
                factor = f"(a{i}_{v} / a{v}_{v})"
                keep = i == v
                cells += [f"a{i}_{j}" if keep else f"a{i}_{j} - {factor} * a{v}_{j} AS a{i}_{j}" for j in k]
                cells.append(f"r{i}" if keep else f"r{i} - {factor} * r{v} AS r{i}")
            out.append(f"system_{step}_{v + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM system_{step}_{v})")
        moved = ", ".join(f"b{i} + r{i} / a{i}_{i} AS b{i}" for i in k)
        out.append(f"beta_{step + 1} AS MATERIALIZED (SELECT {moved} FROM beta_{step}, system_{step}_{len(_TERMS)})")
    out.append(
        f"scored AS MATERIALIZED (SELECT student_id, label, is_train, 1 / (1 + exp(-({line}))) AS dropout_probability "
        f"FROM x, beta_{_NEWTON_STEPS})"
    )
    return ",\n".join(out)


def _auc(relation: str, score: str) -> str:
    return f"""
SELECT round(sum(CASE WHEN label = 1 THEN mid ELSE 0 END - CASE WHEN label = 1 THEN (n1 + 1) / 2.0 ELSE 0 END)
             / max(n1 * n0), 6)::DOUBLE AS auc
FROM (
  SELECT label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS mid,
         sum(label) OVER () AS n1, sum(1 - label) OVER () AS n0
  FROM {relation})"""


_FEATURES = ["attendance_pct", "performance_score", "risk_score", "grade_level", "academic_risk_flag", "attendance_risk_flag", "socio_economic_risk_flag"]


def _raw(select: str) -> str:
    return f"WITH {RAW}\n{select}"


def _silver(select: str) -> str:
    return f"WITH {RAW}, {SILVER}\n{select}"


def _gold(select: str) -> str:
    return f"WITH {RAW}, {SILVER}, {GOLD}\n{select}"


def _ml(select: str) -> str:
    return f"WITH {RAW}, {SILVER}, {GOLD}, {FEATURES}\n{select}"


def _profile_of(relation: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value "
        f"FROM {relation}"
        for c in columns
    )


def _key_check(relation: str, key: str) -> str:
    return f"""
SELECT sum(n)::BIGINT AS total_records, count(*) AS unique_keys,
       count(*) FILTER (n > 1) AS repeated_keys, max(n) AS max_rows_per_key
FROM (SELECT {key}, count(*) AS n FROM {relation} GROUP BY {key})"""


def _counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {relation}" for name, relation in tables.items()
    )


def _trend(relation: str, period: str, event: str, by: str = "") -> str:
    group = f"{by}, {period}" if by else period
    window = f"OVER (PARTITION BY {by} ORDER BY {period})" if by else f"OVER (ORDER BY {period})"
    return f"""
SELECT *, coalesce(rate_change >= 0.02, false) AS alert
FROM (
  SELECT *, round(rate - lag(rate) {window}, 4) AS rate_change
  FROM (
    SELECT {group}, count(*) AS total, count(*) FILTER ({event}) AS events,
           round(count(*) FILTER ({event}) / nullif(count(*), 0)::DOUBLE, 4) AS rate
    FROM {relation} GROUP BY {group}))"""


_ALERT_RISK = "(SELECT p.* FROM alerts a JOIN profile p ON p.student_id = a.student_id)"
_BREAKDOWN = f"""
SELECT 'primary_risk_driver' AS dimension, primary_risk_driver AS value, count(*) AS count
FROM {_ALERT_RISK} GROUP BY primary_risk_driver
UNION ALL
SELECT 'grade_level', grade_level::VARCHAR, count(*) FROM {_ALERT_RISK} GROUP BY grade_level"""
_ADVICE_ROWS = ", ".join(f"({i}, '{line}')" for i, line in enumerate(ADVICE, 1))
_DIGEST = f"""
SELECT 'total' AS section, 1::INTEGER AS rank, 'high_risk_students' AS key, count(*)::DOUBLE AS value FROM alerts
UNION ALL
SELECT * FROM (
  SELECT 'top_students', (row_number() OVER (ORDER BY dropout_probability DESC, student_id))::INTEGER AS r,
         student_id, dropout_probability
  FROM alerts) WHERE r <= 5
UNION ALL
SELECT dimension, (row_number() OVER (PARTITION BY dimension ORDER BY count DESC, value NULLS FIRST))::INTEGER,
       value, count::DOUBLE
FROM ({_BREAKDOWN})
UNION ALL
SELECT 'recommended_actions', i::INTEGER, line, NULL FROM (VALUES {_ADVICE_ROWS}) advice(i, line)"""

_ACADEMIC_COLUMNS = "student_id, round(avg_score, 4) AS avg_score, failed_subjects, performance_score, academic_risk_flag"
_SILVER_TABLES = {
    "silver_students": "s_students",
    "silver_academic_performance": "s_academic",
    "silver_attendance": "s_attendance",
    "silver_socio_economic": "s_socio",
    "silver_retention_status": "s_retention",
}

_CSV = {
    "students": "students_master.csv",
    "academic": "academic_performance.csv",
    "attendance": "attendance_records.csv",
    "socio": "socio_economic_data.csv",
    "retention": "retention_status.csv",
}
_RAW_COLUMNS = {
    "students": ["student_id", "gender", "region", "school_id", "grade_level", "enrollment_year", "program_type"],
    "academic": ["student_id", "avg_score", "failed_subjects"],
    "attendance": ["student_id", "total_days", "days_present"],
    "socio": ["student_id", "family_income_band", "parental_education", "access_to_internet", "working_part_time", "scholarship_status"],
    "retention": ["student_id", "dropout_flag", "dropout_reason", "retention_status"],
}
_LAYERS = f"""
SELECT layer_name, table_name, record_count, 'SUCCESS' AS run_status FROM (
  SELECT 'silver' AS layer_name, table_name, record_count FROM ({_counts(_SILVER_TABLES)})
  UNION ALL SELECT 'bronze', replace(table_name, 'silver_', 'bronze_'), (SELECT count(*) FROM base) FROM ({_counts(_SILVER_TABLES)})
  UNION ALL SELECT 'gold', 'gold_student_risk_profile', count(*) FROM profile
  UNION ALL SELECT 'gold', 'gold_attendance_vs_performance', count(*) FROM profile
  UNION ALL SELECT 'gold', 'gold_dropout_trends', count(DISTINCT (region, grade_level)) FROM profile
  UNION ALL SELECT 'gold', 'gold_intervention_candidates', count(*) FROM profile WHERE intervention_required
  UNION ALL SELECT 'gold', 'gold_retention_overview', 1
  UNION ALL SELECT 'ml', 'gold_dropout_predictions', count(*) FROM scored WHERE NOT is_train
  UNION ALL SELECT 'ml', 'gold_model_metrics', 1
  UNION ALL SELECT 'alerts', 'gold_high_risk_alerts', count(*) FROM predicted
  UNION ALL SELECT 'alerts', 'gold_alert_digest',
    1 + least(count(*), 5) + count(DISTINCT coalesce(primary_risk_driver, '-')) + count(DISTINCT grade_level) + {len(ADVICE)}
    FROM predicted JOIN profile USING (student_id)
  UNION ALL SELECT 'alerts', 'gold_institution_trend', count(DISTINCT enrollment_year) FROM s_students)
UNION ALL SELECT 'extra', 'gold_of_nothing', NULL, 'FAILED'"""

ORACLE: dict[str, str] = {
    "src_csv_scan": _raw("SELECT * FROM raw_students"),
    "src_csv_infer": _raw(
        "SELECT * FROM raw_socio"
    ),
    "src_manifest": _raw(
        "\nUNION ALL\n".join(f"SELECT '{csv}' AS file, count(*) > 0 AS has_bytes FROM raw_{n}" for n, csv in _CSV.items())
    ),
    "src_csv_reordered": _raw(
        "\nUNION ALL\n".join(
            f"SELECT '{csv}' AS file, '{c}' AS column_name, count(*) AS rows, count({c}) AS filled FROM raw_{n}"
            for n, csv in _CSV.items()
            for c in _RAW_COLUMNS[n]
        )
    ),
    "src_csv_rejects": _raw(
        """
SELECT CASE WHEN columns = '' THEN 'accepted' ELSE 'value of another type' END AS outcome, columns, count(*) AS records
FROM (
  SELECT concat_ws(',', CASE WHEN k % 37 = 0 THEN 'avg_score' END, CASE WHEN k % 41 = 0 THEN 'failed_subjects' END) AS columns
  FROM (SELECT student_id[2:]::BIGINT - 100000 AS k FROM raw_academic))
GROUP BY columns"""
    ),
    "src_incremental": _raw(
        "\nUNION ALL\n".join(
            f"SELECT '{n}' AS table_name, {run} AS run, count(*) FILTER ({part}) AS rows FROM raw_{n}"
            for n in _CSV
            for run, part in {1: "student_id[2:]::BIGINT % 2 = 0", 2: "student_id[2:]::BIGINT % 2 = 1", 3: "false"}.items()
        )
    ),
    "bronze_stamp": _raw("SELECT *, 'synthetic_csv' AS source_system, true AS is_stamped FROM raw_socio"),
    "snk_overwrite_table": _silver("SELECT * FROM s_retention"),
    "audit_log": _ml(
        f", {_newton()},\npredicted AS (SELECT * FROM scored WHERE NOT is_train AND dropout_probability >= 0.7)\n{_LAYERS}"
    ),
    "agg_row_counts": _raw(
        _counts({n: f"raw_{n}" for n in ["students", "academic", "attendance", "socio", "retention"]})
    ),
    "agg_global_mean": _raw("SELECT round(avg(avg_score), 6) AS mean_score FROM raw_academic"),
    "dq_profile": _raw(
        _profile_of(
            "raw_students",
            ["student_id", "gender", "region", "school_id", "grade_level", "enrollment_year", "program_type"],
        )
    ),
    "dq_unique_key": _silver(_key_check("s_students", "student_id")),
    "dq_repeated_key": _key_check("orders", "o_custkey"),
    "dq_orphans": _silver(
        """
SELECT found_in, count(*) AS keys, sum(n)::BIGINT AS rows, count(*) FILTER (padded > 0) AS padded_keys,
       sum(padded)::BIGINT AS padded_rows
FROM (
  SELECT string_agg(found, ',' ORDER BY place) AS found_in, sum(n) AS n, sum(padded) AS padded
  FROM (
    SELECT student_id, found, place, count(*) AS n, count(*) FILTER (padded) AS padded
    FROM (
      SELECT student_id, 'students' AS found, 1 AS place, false AS padded FROM s_students
      UNION ALL SELECT student_id, 'academic', 2, false FROM s_academic
      UNION ALL SELECT student_id, 'attendance', 3, student_id LIKE '%3' FROM s_attendance
      UNION ALL SELECT student_id, 'socio', 4, false FROM s_socio
      UNION ALL SELECT student_id, 'retention', 5, false FROM s_retention)
    GROUP BY student_id, found, place)
  GROUP BY student_id)
GROUP BY found_in"""
    ),
    "dq_dedup": """
SELECT o_orderkey, o_custkey, n AS repeats, place = 1 AS keep,
       CASE WHEN n = 1 THEN 'only' WHEN place = 1 THEN 'winner' WHEN o_orderdate <> newest THEN 'o_orderdate'
            ELSE 'o_orderkey' END AS reason
FROM (
  SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM orders)""",
    "dq_inject_errors": _silver(
        f"""
SELECT student_id, school_id, enrollment_year, program_type,
       CASE WHEN {_bucket("region:42")} < 800 THEN lower(region) ELSE region END AS region,
       CASE WHEN {_bucket("gender:42")} < 300 THEN NULL ELSE gender END AS gender,
       CASE WHEN {_bucket("grade_level:42")} < 200 THEN 15 ELSE grade_level END AS grade_level
FROM s_students"""
    ),
    "dq_rejects": _raw(
        """
SELECT student_id, grade_level, enrollment_year,
       CASE WHEN grade_level NOT BETWEEN 1 AND 12 THEN 'grade_level out of range'
            ELSE 'enrollment_year too early' END AS reject_reason
FROM raw_students WHERE grade_level NOT BETWEEN 1 AND 12 OR enrollment_year < 2015"""
    ),
    "silver_students": _silver("SELECT * FROM s_students"),
    "silver_academic": _silver(f"SELECT {_ACADEMIC_COLUMNS} FROM s_academic"),
    "silver_academic_valid_mean": "WITH "
    + RAW
    + ","
    + _academic("v_academic", "SELECT avg(avg_score) FROM raw_academic WHERE avg_score BETWEEN 0 AND 100")
    + f"SELECT {_ACADEMIC_COLUMNS} FROM v_academic",
    "silver_academic_summary": _silver(
        "SELECT count(*) AS records, round(avg(performance_score), 6) AS avg_perf_score, "
        "count(*) FILTER (academic_risk_flag) AS at_risk_students FROM s_academic"
    ),
    "silver_attendance": _silver("SELECT * FROM s_attendance"),
    "silver_attendance_repaired_first": "WITH "
    + RAW
    + ","
    + _attendance("v_attendance", "(CASE WHEN total_days > 0 THEN total_days ELSE 180 END)")
    + "SELECT * FROM v_attendance",
    "silver_socio": _silver("SELECT * FROM s_socio"),
    "silver_audit_stamp": _silver(
        "SELECT replace(table_name, 'silver_', '') AS table_name, true AS is_kept, true AS is_updated, "
        "'synthetic_csv' AS source_system, record_count AS rows "
        f"FROM ({_counts({n: 's_' + n for n in _CSV})})"
    ),
    "silver_retention": _silver("SELECT * FROM s_retention"),
    "silver_retention_summary": _silver(
        "SELECT retention_status, count(*) AS count FROM s_retention GROUP BY retention_status"
    ),
    "label_factor_count": _silver(
        """
SELECT student_id, factors, factors >= 3 AS dropout_flag
FROM (
  SELECT a.student_id, (CASE WHEN avg_score < 50 THEN 1 ELSE 0 END + CASE WHEN attendance_pct < 75 THEN 1 ELSE 0 END
         + CASE WHEN family_income_band = 'LOW' THEN 1 ELSE 0 END
         + CASE WHEN working_part_time THEN 1 ELSE 0 END)::INTEGER AS factors
  FROM s_academic a JOIN s_attendance t ON t.student_id = a.student_id JOIN s_socio e ON e.student_id = a.student_id)"""
    ),
    "score_clip_band": _raw(
        """
SELECT student_id, avg_score, avg_score > 60 AS improvement_flag,
       CASE WHEN avg_score <= 0 THEN NULL WHEN avg_score <= 50 THEN 'Low' WHEN avg_score <= 70 THEN 'Medium'
            WHEN avg_score <= 100 THEN 'High' END AS performance_band
FROM (
  SELECT student_id, CASE WHEN avg_score < 30 THEN 30 WHEN avg_score > 95 THEN 95 ELSE avg_score END AS avg_score
  FROM raw_academic)"""
    ),
    "join_left_star": _gold("SELECT * FROM flags"),
    "join_left_star_split": _gold("SELECT * FROM flags"),
    "join_hot_keys": "SELECT c_custkey AS k, c_mktsegment, o_orderkey, o_orderstatus "
    "FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
    "gold_risk_score": _gold("SELECT student_id, risk_score, risk_level, intervention_required FROM profile"),
    "gold_primary_driver": _gold(
        "SELECT student_id, primary_risk_driver, CASE WHEN attendance_risk_flag THEN 'ATTENDANCE' "
        "WHEN academic_risk_flag THEN 'ACADEMIC' WHEN socio_economic_risk_flag THEN 'SOCIO_ECONOMIC' END "
        "AS driver_by_priority FROM profile"
    ),
    "gold_student_risk_profile": _gold("SELECT * FROM profile"),
    "gold_attendance_vs_performance": _gold(
        """
SELECT *, attendance_band IN ('VERY LOW', 'LOW') AND performance_band = 'LOW' AS combined_risk_flag
FROM (
  SELECT s.student_id, gender, region, school_id, grade_level, program_type, attendance_pct, attendance_risk_flag,
         performance_score, academic_risk_flag,
         CASE WHEN attendance_pct < 60 THEN 'VERY LOW' WHEN attendance_pct < 75 THEN 'LOW'
              WHEN attendance_pct < 90 THEN 'MEDIUM' ELSE 'HIGH' END AS attendance_band,
         CASE WHEN performance_score < 50 THEN 'LOW' WHEN performance_score < 70 THEN 'MEDIUM'
              ELSE 'HIGH' END AS performance_band
  FROM s_students s JOIN s_attendance t ON t.student_id = s.student_id
  JOIN s_academic a ON a.student_id = s.student_id)"""
    ),
    "gold_dropout_trends": _silver(
        """
SELECT region, grade_level, count(*) AS total_students,
       count(*) FILTER (retention_status = 'DROPPED') AS dropped_students,
       round(count(*) FILTER (retention_status = 'DROPPED') / count(*)::DOUBLE, 4) AS dropout_rate
FROM s_students s JOIN s_retention r ON r.student_id = s.student_id
GROUP BY region, grade_level"""
    ),
    "gold_intervention_candidates": _gold(
        "SELECT p.student_id, grade_level, region, risk_score, risk_level, primary_risk_driver, "
        "intervention_required, r.retention_status FROM profile p "
        "JOIN s_retention r ON r.student_id = p.student_id WHERE intervention_required"
    ),
    "gold_retention_overview": _silver(
        """
SELECT *, round(retained_students / nullif(total_students, 0)::DOUBLE, 4) AS retention_rate,
       round(dropped_students / nullif(total_students, 0)::DOUBLE, 4) AS dropout_rate
FROM (
  SELECT count(*) AS total_students, count(*) FILTER (retention_status = 'RETAINED') AS retained_students,
         count(*) FILTER (retention_status = 'DROPPED') AS dropped_students
  FROM s_retention)"""
    ),
    "gold_walkthrough": _gold(
        "SELECT student_id, grade_level, attendance_pct, performance_score, risk_score, risk_level, "
        "primary_risk_driver, intervention_required FROM profile ORDER BY student_id LIMIT 20"
    ),
    "ml_features": _ml("SELECT * FROM features"),
    "ml_hash_split": _ml(f"SELECT student_id, {_bucket('42')} < 8000 AS is_train FROM features"),
    "ml_scored_students": _ml(
        f"SELECT student_id, true AS is_probability, label FROM features WHERE {_bucket('42')} >= 8000"
    ),
    "ml_calibration": _ml(
        "SELECT count(*) AS train_rows, sum(label)::BIGINT AS dropped, sum(label)::DOUBLE AS expected_dropped "
        f"FROM features WHERE {_bucket('42')} < 8000"
    ),
    "ml_auc_rank": _gold(
        _auc("(SELECT risk_score, CASE WHEN retention_risk_flag THEN 1 ELSE 0 END AS label FROM profile)", "risk_score")
    ),
    "ml_predictions": _ml(
        f", {_newton()}\nSELECT student_id, round(dropout_probability, 3) AS dropout_probability FROM scored WHERE NOT is_train"
    ),
    "ml_model_auc": _ml(f", {_newton()}\n{_auc('scored WHERE NOT is_train', 'dropout_probability')}"),
    "ml_score_equations": _ml(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS term, round(sum({x})::DOUBLE, 4) AS observed, 1.0::DOUBLE AS explained "
            f"FROM features WHERE {_bucket('42')} < 8000 AND label = 1"
            for t, x in {"intercept": "1", **{f: f for f in _FEATURES}}.items()
        )
    ),
    "ml_gram": _ml(
        "\nUNION ALL\n".join(
            f"SELECT '{a}' AS row_feature, '{b}' AS column_feature, round(sum({a}::DOUBLE * {b}), 2) AS product "
            f"FROM features WHERE {_bucket('42')} < 8000"
            for i, a in enumerate(_FEATURES)
            for b in _FEATURES[i:]
        )
    ),
    "pred_with_risk_topk": _gold(
        "SELECT p.student_id, dropout_probability, risk_level, intervention_required "
        "FROM predictions p JOIN profile g ON p.student_id = g.student_id "
        "ORDER BY dropout_probability DESC, p.student_id LIMIT 20"
    ),
    "alert_threshold_ge": _gold("SELECT * FROM alerts"),
    "alert_threshold_gt": _gold("SELECT * FROM predictions WHERE dropout_probability > 0.7"),
    "alert_ranked": _gold(
        "SELECT *, row_number() OVER (ORDER BY dropout_probability DESC, student_id) AS alert_rank FROM alerts"
    ),
    "alert_count": _gold("SELECT count(*) AS high_risk_count FROM alerts"),
    "alert_topk": _gold("SELECT * FROM alerts ORDER BY dropout_probability DESC, student_id LIMIT 5"),
    "alert_driver_counts": _gold(
        f"SELECT primary_risk_driver, count(*) AS count FROM {_ALERT_RISK} GROUP BY primary_risk_driver"
    ),
    "alert_grade_counts": _gold(f"SELECT grade_level, count(*) AS count FROM {_ALERT_RISK} GROUP BY grade_level"),
    "alert_breakdown_sets": _gold(_BREAKDOWN),
    "alert_digest": _gold(_DIGEST),
    "alert_institution_trend": _silver(
        _trend(
            "(SELECT * FROM s_students s JOIN s_retention r ON r.student_id = s.student_id)",
            "enrollment_year",
            "retention_risk_flag",
        )
    ),
    "alert_region_trend": _silver(
        _trend(
            "(SELECT * FROM s_students s JOIN s_retention r ON r.student_id = s.student_id)",
            "enrollment_year",
            "retention_risk_flag",
            by="region",
        )
    ),
    "alert_order_trend": _trend(
        "(SELECT year(o_orderdate)::INTEGER AS order_year, o_orderstatus FROM orders)",
        "order_year",
        "o_orderstatus = 'F'",
    ),
    "alert_event_trend": _trend(
        "(SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, event_type FROM events)", "minute", "event_type = 'error'"
    ),
}
