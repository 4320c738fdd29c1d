"""DuckDB SQL for the registered queries.

Each statement starts from the source tables and never reads engine output, so
the JSON round trip, the stored layers and the streams are all tested by it.
"""

from __future__ import annotations


def _hash(key: str, tag: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{tag}'), 1, 8)) AS BIGINT)"


def _o(tag: str) -> str:
    return _hash("o_orderkey", tag)


def _c(tag: str) -> str:
    return _hash("c_custkey", tag)


AS_OF = "TIMESTAMP '2024-06-01 00:00:00'"
NOW = "1717200000"
CHARGES = ("['Theft','Assault','Drug Possession','DUI','Burglary','Fraud',"
           "'Traffic Violation','Domestic Violence']")
STATUSES = ("['Private Attorney','Public Defender Assigned','Public Defender Requested',"
            "'Self-Represented','Attorney Pending']")
HEARINGS = "['Arraignment','Pre-trial','Plea Hearing','Trial','Sentencing']"
ZIPS = "[10001,10002,10003,11201,11205,11215,11101,11103,10451,10452,10301,10302]"
BOROUGHS = "['Manhattan','Brooklyn','Queens','Bronx','Staten Island']"
CODES = "['MN','BK','QN','BX','SI']"

EVENTS = f"""
keyed AS (
  SELECT o_orderkey, c_custkey, c_acctbal, n_name, n_regionkey, o_orderpriority,
         {NOW} - (1 + {_o('filed')} % 90) * 86400 + {_o('sec')} % 86400 AS filed_s
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
),
events_of_court AS (
  SELECT
    o_orderkey AS feed_key,
    '2024-' || {CODES}[n_regionkey + 1] || '-' || printf('%09d', o_orderkey)
      AS case_id,
    'DEF-' || printf('%09d', c_custkey) AS defendant_id,
    {CHARGES}[{_o('chg')} % 8 + 1] AS charge_type,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Felony'
         WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'Misdemeanor'
         ELSE 'Violation' END AS charge_severity,
    ['Filed','Pending','Active','Scheduled'][{_o('cst')} % 4 + 1] AS case_status,
    {STATUSES}[{_o('att')} % 5 + 1] AS attorney_status,
    CASE WHEN {_c('agenull')} % 101 = 0 THEN NULL
         ELSE CAST(16 + {_c('age')} % 62 AS INTEGER) END AS defendant_age,
    ['Male','Female','Other'][{_c('gen')} % 3 + 1] AS defendant_gender,
    CASE WHEN c_acctbal < 2500 THEN 'Low' WHEN c_acctbal < 6500 THEN 'Medium'
         ELSE 'High' END AS income_level,
    CASE WHEN {_o('zipnull')} % 100 < 3 THEN NULL
         ELSE CAST({ZIPS}[{_c('zip')} % 12 + 1] AS INTEGER) END AS raw_zip,
    {BOROUGHS}[n_regionkey + 1] || ' Criminal Court' AS court_district,
    {CODES}[n_regionkey + 1] AS court_district_code,
    n_name AS assigned_judge,
    {HEARINGS}[{_o('hty')} % 5 + 1] AS hearing_type,
    epoch_ms(filed_s * 1000) AS filed,
    epoch_ms(1000 * CASE WHEN {_o('fut')} % 100 < 2 THEN {NOW} + (60 + {_o('futd')} % 61) * 86400
                  ELSE filed_s + (7 + {_o('hear')} % 39) * 86400 END) AS raw_hearing,
    CAST(o_orderkey % 8 AS INTEGER) AS hub_partition,
    o_orderkey // 8 AS hub_offset
  FROM keyed
)"""

CLEAN = f"""
repaired AS (
  SELECT *, coalesce(raw_zip, 99999) AS zip,
         CASE WHEN raw_hearing > {AS_OF} THEN filed + INTERVAL 14 DAY ELSE raw_hearing END
           AS hearing
  FROM events_of_court
),
timed AS (
  SELECT *, CAST(date_diff('day', {AS_OF}, hearing) AS INTEGER) AS days_to_hearing,
         CAST(date_diff('day', filed, {AS_OF}) AS INTEGER) AS case_duration_days
  FROM repaired
),
cleaned AS (
  SELECT *,
    CASE
      WHEN attorney_status IN ('Private Attorney', 'Public Defender Assigned') THEN FALSE
      WHEN charge_severity = 'Felony'
           AND attorney_status IN ('Self-Represented', 'Attorney Pending') THEN TRUE
      WHEN income_level = 'Low' AND attorney_status IN
           ('Self-Represented', 'Public Defender Requested', 'Attorney Pending') THEN TRUE
      WHEN days_to_hearing <= 7
           AND attorney_status IN ('Self-Represented', 'Attorney Pending') THEN TRUE
      ELSE FALSE END AS needs_representation,
    income_level = 'Low' AS public_defender_eligible,
    CASE WHEN defendant_age <= 25 THEN '18-25' WHEN defendant_age <= 35 THEN '26-35'
         WHEN defendant_age <= 45 THEN '36-45' WHEN defendant_age <= 55 THEN '46-55'
         WHEN defendant_age <= 65 THEN '56-65' ELSE '65+' END AS defendant_age_group
  FROM timed
)"""

DEFENDANT_SET = ("defendant_id, defendant_age, defendant_age_group, defendant_gender, "
                 "income_level, zip, attorney_status, public_defender_eligible")
CASE_SET = "case_id, charge_type, charge_severity, case_status, hearing_type"
COURT_SET = "court_district, assigned_judge, court_district_code"


def _ordered(columns: str) -> str:
    return ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))


FACT = f"""
scored AS (
  SELECT *,
    CASE WHEN NOT needs_representation THEN 1 WHEN days_to_hearing <= 2 THEN 10
         WHEN days_to_hearing <= 7 THEN 8 ELSE 6 END AS score,
    CASE WHEN needs_representation THEN 100000 + {_hash('case_id', 'cost')} % 300000
         ELSE 50000 + {_hash('case_id', 'cost')} % 150000 END AS cost_cents,
    dense_rank() OVER (ORDER BY {_ordered(DEFENDANT_SET)}) AS defendant_sk,
    dense_rank() OVER (ORDER BY {_ordered(CASE_SET)}) AS case_details_sk,
    dense_rank() OVER (ORDER BY {_ordered(COURT_SET)}) AS court_sk,
    row_number() OVER (ORDER BY case_id, defendant_id, filed, hub_partition, hub_offset)
      AS proceeding_sk
  FROM cleaned
),
fact AS (
  SELECT *, score >= 7 AS alert_triggered,
    CASE WHEN score >= 9 THEN 'CRITICAL' WHEN score >= 7 THEN 'HIGH'
         WHEN score >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS alert_priority,
    CASE WHEN score >= 8 THEN 'Critical' WHEN score >= 6 THEN 'High'
         WHEN score >= 4 THEN 'Medium' ELSE 'Low' END AS priority_category,
    CASE WHEN days_to_hearing <= 3 THEN 'URGENT' WHEN days_to_hearing <= 7 THEN 'SOON'
         ELSE 'SCHEDULED' END AS hearing_urgency_flag
  FROM scored
)"""

# successive attorney statuses per defendant
VERSIONS = """
stepped AS (
  SELECT *, lag(attorney_status) OVER d AS was, row_number() OVER d AS nth
  FROM cleaned WINDOW d AS (PARTITION BY defendant_id ORDER BY filed, hub_offset, hub_partition)
),
changed AS (
  SELECT * FROM stepped WHERE nth = 1 OR attorney_status IS DISTINCT FROM was
),
versions AS (
  SELECT defendant_id, attorney_status, filed AS effective, feed_key,
         lead(filed) OVER d AS ended, lead(feed_key) OVER d IS NULL AS is_current,
         row_number() OVER d AS version
  FROM changed WINDOW d AS (PARTITION BY defendant_id ORDER BY filed, hub_offset, hub_partition)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n"


def _text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


def _json_time(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S') AS {name}"


def _pct(part: str, whole: str) -> str:
    return (f"CASE WHEN {whole} > 0 THEN CAST((2000 * {part} + {whole}) // (2 * {whole}) "
            f"AS DOUBLE) / CAST(10 AS DOUBLE) END")


def _money(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE) / CAST(100 AS DOUBLE)"


NOW_TEXT = "'2024-06-01 00:00:00'"
NEED = "count(*) FILTER (WHERE needs_representation)"
MEAN_SCORE = "CAST(sum(score) AS DOUBLE) / count(score)"
PAYLOAD = f"""case_id, defendant_id, charge_type, charge_severity, case_status, attorney_status,
  defendant_age, defendant_gender, income_level, raw_zip AS defendant_zip_code, court_district,
  assigned_judge, hearing_type, {_json_time('filed', 'case_filed_date')},
  {_json_time('raw_hearing', 'hearing_date')}, {_json_time('filed', 'record_timestamp')}"""
HUB = f"{_text('filed', 'eventhub_timestamp')}, hub_partition AS eventhub_partition, " \
      "hub_offset AS eventhub_offset"
FIRST_VERSION = (f"{NOW_TEXT} AS record_effective_date, CAST(NULL AS VARCHAR) AS record_end_date, "
                 f"TRUE AS is_current, CAST(1 AS INTEGER) AS record_version, "
                 f"{NOW_TEXT} AS created_timestamp")
DIM_DEFENDANT = f"""SELECT row_number() OVER (ORDER BY {_ordered(DEFENDANT_SET)}) AS defendant_sk,
  defendant_id, defendant_age, defendant_age_group, defendant_gender, income_level,
  zip AS defendant_zip_code, attorney_status, public_defender_eligible, {FIRST_VERSION}
  FROM (SELECT DISTINCT {DEFENDANT_SET} FROM cleaned)"""
DIM_CASE = f"""SELECT row_number() OVER (ORDER BY {_ordered(CASE_SET)}) AS case_details_sk,
  {CASE_SET}, {FIRST_VERSION} FROM (SELECT DISTINCT {CASE_SET} FROM cleaned)"""
DIM_COURT = f"""SELECT row_number() OVER (ORDER BY {_ordered(COURT_SET)}) AS court_sk,
  {COURT_SET}, {NOW_TEXT} AS created_timestamp FROM (SELECT DISTINCT {COURT_SET} FROM cleaned)"""
FACT_COLUMNS = f"""SELECT proceeding_sk, defendant_sk, case_details_sk, court_sk, case_id,
  defendant_id, {_text('filed', 'case_filed_date')}, {_text('hearing', 'hearing_date')},
  days_to_hearing, case_duration_days, needs_representation,
  CAST(score AS INTEGER) AS representation_priority_score, alert_triggered, alert_priority,
  alert_triggered AS intervention_needed, {_money('cost_cents')} AS estimated_case_cost,
  hearing_urgency_flag, {_text('filed', 'eventhub_timestamp')},
  {NOW_TEXT} AS silver_processed_timestamp, {NOW_TEXT} AS gold_processed_timestamp FROM fact"""
VIEW = f"""SELECT proceeding_sk, case_id, defendant_id, {_text('filed', 'case_filed_date')},
  {_text('hearing', 'hearing_date')}, days_to_hearing, case_duration_days, needs_representation,
  CAST(score AS INTEGER) AS representation_priority_score, alert_triggered, alert_priority,
  alert_triggered AS intervention_needed, {_money('cost_cents')} AS estimated_case_cost,
  hearing_urgency_flag, defendant_age, defendant_age_group, defendant_gender, income_level,
  zip AS defendant_zip_code, attorney_status, public_defender_eligible, charge_type,
  charge_severity, case_status, hearing_type, court_district, court_district_code, assigned_judge,
  priority_category,
  CASE WHEN days_to_hearing <= 3 THEN 'Urgent' WHEN days_to_hearing <= 7 THEN 'Soon'
       ELSE 'Scheduled' END AS hearing_urgency_category FROM fact"""
COUNTS = """SELECT 'fact_court_proceedings' AS table_name, count(*) AS row_count FROM cleaned
  UNION ALL SELECT 'dim_defendant', count(*) FROM (SELECT DISTINCT {d} FROM cleaned)
  UNION ALL SELECT 'dim_case_details', count(*) FROM (SELECT DISTINCT {c} FROM cleaned)
  UNION ALL SELECT 'dim_court', count(*) FROM (SELECT DISTINCT {t} FROM cleaned)""".format(
    d=DEFENDANT_SET, c=CASE_SET, t=COURT_SET)
VERSION_COLUMNS = (f"{_text('effective', 'record_effective_date')}, "
                   f"{_text('ended', 'record_end_date')}, is_current, "
                   "CAST(version AS INTEGER) AS record_version")
GAP = f"count(*) AS cases, {NEED} AS gap_cases, {_pct(NEED, 'count(*)')} AS gap_rate"



def _lengths() -> str:
    declared = {
        "fact_court_proceedings": "case_id 50, defendant_id 50, alert_priority 20, "
                                  "hearing_urgency_flag 20",
        "dim_defendant": "defendant_id 50, defendant_age_group 10, defendant_gender 10, "
                         "income_level 10, attorney_status 50",
        "dim_case_details": "case_id 50, charge_type 50, charge_severity 20, case_status 30, "
                            "hearing_type 30",
        "dim_court": "court_district 50, court_district_code 5, assigned_judge 50",
    }
    sets = {"dim_defendant": DEFENDANT_SET, "dim_case_details": CASE_SET, "dim_court": COURT_SET}
    parts = []
    for table, columns in declared.items():
        source = f"(SELECT DISTINCT {sets[table]} FROM fact)" if table in sets else "fact"
        for entry in columns.split(", "):
            column, limit = entry.split()
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"CAST({limit} AS INTEGER) AS declared, "
                f"CAST(max(length({column})) AS INTEGER) AS longest, "
                f"count(*) FILTER (WHERE length({column}) > {limit}) AS too_long FROM {source}")
    return " UNION ALL ".join(parts)


_EVENTS = _with(EVENTS)
_CLEAN = _with(EVENTS, CLEAN)
_FACT = _with(EVENTS, CLEAN, FACT)
_VERSIONS = _with(EVENTS, CLEAN, VERSIONS)

SQL: dict[str, str] = {
    "feed_envelope": f"{_EVENTS} SELECT {PAYLOAD} FROM events_of_court",
    "silver_parse": f"{_EVENTS} SELECT {PAYLOAD}, {HUB} FROM events_of_court",
    "silver_clean": f"""{_CLEAN} SELECT case_id, defendant_id, charge_type, charge_severity,
        case_status, attorney_status, defendant_age, defendant_gender, income_level,
        zip AS defendant_zip_code, court_district, assigned_judge, hearing_type,
        {_text('filed', 'case_filed_date')}, {_text('hearing', 'hearing_date')},
        {_text('filed', 'record_timestamp')}, {HUB}, {NOW_TEXT} AS bronze_ingestion_timestamp,
        days_to_hearing, case_duration_days, needs_representation, public_defender_eligible,
        defendant_age_group, court_district_code, {NOW_TEXT} AS silver_processed_timestamp,
        CASE WHEN zip = 99999 THEN 'MISSING_ZIP_CODE' ELSE 'CLEAN' END AS data_quality_flag
        FROM cleaned""",
    "silver_extras": f"""{_CLEAN} SELECT case_id, hearing < {AS_OF} AS hearing_is_past,
        raw_hearing > {AS_OF} AS hearing_was_repaired,
        defendant_age IS NOT NULL AS age_is_known FROM cleaned""",
    "silver_sample": f"""{_CLEAN} SELECT case_id, attorney_status, charge_severity, income_level,
        days_to_hearing, needs_representation,
        CASE WHEN zip = 99999 THEN 'MISSING_ZIP_CODE' ELSE 'CLEAN' END AS data_quality_flag
        FROM cleaned ORDER BY case_id, attorney_status, charge_severity LIMIT 10""",
    "silver_rejects": """SELECT doc_id AS eventhub_offset, text AS raw_json FROM documents
        WHERE text IS NULL OR NOT json_valid(text)""",
    "needs_representation": f"""{_CLEAN} SELECT case_id, defendant_id, needs_representation
        FROM cleaned""",
    "age_group_counts": f"""{_CLEAN} SELECT defendant_age_group, count(*) AS cases FROM cleaned
        GROUP BY defendant_age_group""",
    "silver_quality": f"""{_CLEAN} SELECT count(*) AS total_records,
        count(*) FILTER (WHERE case_id IS NULL) AS null_case_ids,
        count(*) FILTER (WHERE defendant_id IS NULL) AS null_defendant_ids,
        count(*) FILTER (WHERE zip = 99999) AS missing_zip_codes,
        {NEED} AS needs_representation_count,
        {_pct(NEED, 'count(*)')} AS needs_representation_pct FROM cleaned""",
    "attorney_status_summary": f"""{_CLEAN} SELECT attorney_status, needs_representation,
        count(*) AS cases FROM cleaned GROUP BY attorney_status, needs_representation""",
    "unreadable_fields": f"""{_EVENTS}, lost AS (
        SELECT 'defendant_age' AS field FROM events_of_court
        WHERE {_hash('feed_key', 'badage')} % 30 = 0 AND defendant_age IS NOT NULL
        UNION ALL SELECT 'defendant_zip_code' FROM events_of_court
        WHERE {_hash('feed_key', 'badzip')} % 40 = 0 AND raw_zip IS NOT NULL)
        SELECT field, count(*) AS records FROM lost GROUP BY field""",
    "district_summary": f"""{_CLEAN} SELECT court_district_code, count(*) AS total_cases,
        {NEED} AS needs_representation_count,
        {_pct(NEED, 'count(*)')} AS representation_gap_rate
        FROM cleaned GROUP BY court_district_code""",
    "date_quality": f"""{_EVENTS}, judged AS (
        SELECT CASE WHEN {_hash('feed_key', 'baddate')} % 50 = 0 THEN 'UNREADABLE_HEARING_DATE'
          WHEN {_hash('feed_key', 'early')} % 40 = 0 THEN 'HEARING_BEFORE_FILING'
          WHEN raw_hearing > {AS_OF} THEN 'HEARING_IN_FUTURE'
          ELSE 'CONSISTENT' END AS date_issue FROM events_of_court)
        SELECT date_issue, count(*) AS records FROM judged GROUP BY date_issue""",
    "schema_evolution": f"""{_EVENTS} SELECT case_id,
        CASE WHEN {_hash('feed_key', 'v2')} % 2 = 1
          THEN 'R' || lpad(CAST({_hash('feed_key', 'room')} % 30 AS VARCHAR), 2, '0') END
          AS court_room,
        CAST(CASE WHEN {_hash('feed_key', 'v2')} % 2 = 1 THEN 2 ELSE 1 END AS INTEGER) AS version
        FROM events_of_court""",
    "dim_defendant": f"{_CLEAN} {DIM_DEFENDANT}",
    "dim_case_details": f"{_CLEAN} {DIM_CASE}",
    "dim_court": f"{_CLEAN} {DIM_COURT}",
    "fact_keys_literal": f"""{_FACT},
        defendants AS (SELECT DISTINCT defendant_sk, defendant_id FROM fact),
        cases AS (SELECT DISTINCT case_details_sk, case_id FROM fact),
        courts AS (SELECT DISTINCT court_sk, court_district, assigned_judge FROM fact)
        SELECT d.defendant_sk, k.case_details_sk, t.court_sk, c.case_id, c.defendant_id
        FROM cleaned c JOIN defendants d USING (defendant_id) JOIN cases k USING (case_id)
        JOIN courts t USING (court_district, assigned_judge)""",
    "fact": f"{_FACT} {FACT_COLUMNS}",
    "star_increment": f"""{_FACT}, loaded AS (
          SELECT *, filed >= {AS_OF} - INTERVAL 45 DAY AS second FROM fact),
        first_seen AS (
          SELECT *, min(second) OVER (PARTITION BY defendant_sk) AS d,
            min(second) OVER (PARTITION BY case_details_sk) AS c,
            min(second) OVER (PARTITION BY court_sk) AS t FROM loaded)
        SELECT row_number() OVER (ORDER BY second, proceeding_sk) AS proceeding_sk,
          dense_rank() OVER (ORDER BY d, defendant_sk) AS defendant_sk,
          dense_rank() OVER (ORDER BY c, case_details_sk) AS case_details_sk,
          dense_rank() OVER (ORDER BY t, court_sk) AS court_sk, case_id FROM first_seen""",
    "priority_scores": f"""{_FACT} SELECT proceeding_sk, case_id, needs_representation,
        CAST(score AS INTEGER) AS representation_priority_score, alert_triggered, alert_priority,
        alert_triggered AS intervention_needed FROM fact""",
    "alert_distribution": f"""{_FACT} SELECT alert_priority, count(*) AS proceedings FROM fact
        GROUP BY alert_priority""",
    "urgency_counts": f"""{_FACT} SELECT hearing_urgency_flag, count(*) AS proceedings FROM fact
        GROUP BY hearing_urgency_flag""",
    "case_costs": f"""{_FACT} SELECT case_id, needs_representation,
        {_money('cost_cents')} AS estimated_case_cost FROM fact""",
    "gold_summary": f"""{_FACT} SELECT count(*) AS total_proceedings,
        {NEED} AS needs_representation_count,
        {_pct(NEED, 'count(*)')} AS needs_representation_pct,
        count(*) FILTER (WHERE alert_priority = 'HIGH') AS high_priority_alerts,
        count(*) FILTER (WHERE alert_priority = 'CRITICAL') AS critical_alerts FROM fact""",
    "row_counts": f"{_CLEAN} {COUNTS}",
    "serve_tables": f"{_CLEAN} {COUNTS}",
    "serve_dim_defendant": f"{_CLEAN} {DIM_DEFENDANT} ORDER BY defendant_sk LIMIT 10",
    "serve_dim_case_details": f"{_CLEAN} {DIM_CASE} ORDER BY case_details_sk LIMIT 10",
    "serve_dim_court": f"{_CLEAN} {DIM_COURT} ORDER BY court_sk LIMIT 10",
    "serve_fact_court_proceedings": f"{_FACT} {FACT_COLUMNS} ORDER BY proceeding_sk LIMIT 10",
    "text_lengths": f"{_FACT} {_lengths()}",
    "analytics_view": f"{_FACT} {VIEW}",
    "gap_summary": f"""{_FACT} SELECT court_district, court_district_code, charge_severity,
        income_level, count(*) AS total_cases, {NEED} AS cases_needing_representation,
        count(*) FILTER (WHERE alert_triggered) AS alerts_triggered,
        {MEAN_SCORE} AS avg_priority_score, {_money('sum(cost_cents)')} AS total_estimated_cost
        FROM fact GROUP BY court_district, court_district_code, charge_severity, income_level""",
    "top_cases": f"""{_FACT} {VIEW} WHERE needs_representation
        ORDER BY score DESC, fact.days_to_hearing, proceeding_sk LIMIT 10""",
    "validation_stats": f"""{_FACT} SELECT count(*) AS total_proceedings,
        {NEED} AS needs_representation_count, {MEAN_SCORE} AS avg_priority_score,
        count(DISTINCT court_district) AS unique_courts,
        count(DISTINCT defendant_id) AS unique_defendants FROM fact""",
    "dedupe_latest": """SELECT * EXCLUDE (nth, l_shipdate),
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
              l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
              l_linestatus DESC) AS nth FROM lineitem) WHERE nth = 1""",
    "scd2_history": f"""{_VERSIONS} SELECT defendant_id, attorney_status, {VERSION_COLUMNS}
        FROM versions""",
    "scd2_merge": f"""{_VERSIONS} SELECT row_number() OVER (
          ORDER BY effective >= {AS_OF} - INTERVAL 45 DAY, defendant_id, version) AS defendant_sk,
        defendant_id, attorney_status, {VERSION_COLUMNS} FROM versions""",
    "scd2_merge_late": f"""{_VERSIONS} SELECT defendant_id, attorney_status, {VERSION_COLUMNS}
        FROM versions""",
    "case_history": f"""{_VERSIONS} SELECT c.case_id, c.defendant_id,
        {_text('c.filed', 'record_timestamp')}, v.attorney_status, {VERSION_COLUMNS}
        FROM cleaned c JOIN versions v ON c.defendant_id = v.defendant_id
          AND c.filed >= v.effective AND (v.ended IS NULL OR c.filed < v.ended)""",
    "status_changes": f"""{_VERSIONS.rstrip()},
        stepped_by_case AS (
          SELECT defendant_id, case_id, attorney_status, filed,
                 lag(attorney_status) OVER d AS was, row_number() OVER d AS nth
          FROM cleaned WINDOW d AS (
            PARTITION BY defendant_id ORDER BY filed, case_id, hub_partition, hub_offset))
        SELECT defendant_id, case_id, was AS from_status, attorney_status AS to_status,
        {_text('filed', 'changed_at')} FROM stepped_by_case
        WHERE nth > 1 AND attorney_status IS DISTINCT FROM was""",
    "work_queue": f"""{_FACT}, queued AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY court_district
            ORDER BY score DESC, days_to_hearing, proceeding_sk) AS INTEGER) AS queue_position
          FROM fact WHERE needs_representation)
        SELECT court_district, queue_position, proceeding_sk, case_id, defendant_id,
        CAST(score AS INTEGER) AS representation_priority_score, days_to_hearing, attorney_status
        FROM queued WHERE queue_position <= 20""",
    "weekly_trend": f"""{_FACT}, weekly AS (
          SELECT CAST(date_trunc('week', filed) AS DATE) AS week, count(*) AS filings,
            {NEED} AS gap_cases, {_pct(NEED, 'count(*)')} AS gap_rate FROM fact GROUP BY 1)
        SELECT w.*,
          CASE WHEN w.week > (SELECT min(week) FROM weekly)
            THEN w.filings - coalesce(b.filings, 0) END AS filings_change,
          CASE WHEN w.week > (SELECT min(week) FROM weekly)
            THEN w.gap_cases - coalesce(b.gap_cases, 0) END AS gap_change
        FROM weekly w LEFT JOIN weekly b ON b.week = w.week - 7""",
    "demographics": f"""{_FACT} SELECT defendant_age_group, income_level, charge_type,
        CAST(grouping(defendant_age_group, income_level, charge_type) AS INTEGER)
          AS grouping_level, {GAP}
        FROM fact GROUP BY GROUPING SETS
          ((defendant_age_group), (income_level), (charge_type), ())""",
    "geo_rollup": f"""{_FACT} SELECT court_district, assigned_judge,
        CAST(grouping(court_district, assigned_judge) AS INTEGER) AS grouping_level, {GAP},
        {_money('sum(cost_cents)')} AS total_cost
        FROM fact GROUP BY ROLLUP (court_district, assigned_judge)""",
    "budget_by_month": f"""{_FACT}, monthly AS (
          SELECT court_district, CAST(date_trunc('month', filed) AS DATE) AS month,
            count(*) AS cases, sum(cost_cents) AS spent FROM fact GROUP BY 1, 2)
        SELECT court_district, month, cases, {_money('spent')} AS month_cost,
          {_money('sum(spent) OVER (PARTITION BY court_district ORDER BY month)')} AS running_cost
        FROM monthly""",
    "executive_kpis": f"""{_FACT} SELECT count(*) AS proceedings, {NEED} AS gap_cases,
        {_pct(NEED, 'count(*)')} AS gap_rate,
        count(*) FILTER (WHERE alert_triggered) AS alerts,
        count(*) FILTER (WHERE alert_priority = 'CRITICAL') AS critical_alerts,
        count(DISTINCT court_district) AS districts,
        count(DISTINCT (court_district, assigned_judge)) AS courts,
        count(DISTINCT defendant_id) AS defendants, {MEAN_SCORE} AS avg_priority_score,
        {_money('sum(cost_cents)')} AS total_cost FROM fact""",
    "weighted_score": f"""{_FACT} SELECT proceeding_sk, case_id,
        CAST(score AS INTEGER) AS representation_priority_score,
        CAST(CASE WHEN NOT needs_representation THEN 1 ELSE
          CASE WHEN days_to_hearing <= 2 THEN 5 WHEN days_to_hearing <= 7 THEN 3 ELSE 1 END
          + CASE charge_severity WHEN 'Felony' THEN 3 WHEN 'Misdemeanor' THEN 2
                 WHEN 'Violation' THEN 1 ELSE 0 END
          + CASE income_level WHEN 'Low' THEN 2 WHEN 'Medium' THEN 1 ELSE 0 END
          END AS INTEGER) AS weighted_score FROM fact""",
    "bronze_ingest": f"""{_EVENTS} SELECT {HUB}, case_id,
        {_json_time('raw_hearing', 'hearing_date')} FROM events_of_court""",
    "stream_dedupe": f"{_EVENTS} SELECT {HUB}, case_id FROM events_of_court",
    "stream_alert_feed": f"""{_FACT} SELECT case_id, defendant_id, court_district_code,
        {_text('filed', 'eventhub_timestamp')},
        CAST(score AS INTEGER) AS representation_priority_score, alert_priority
        FROM fact WHERE alert_triggered""",
    "stream_alerts": f"""{_FACT}, closed AS (
          SELECT *, date_trunc('day', filed) AS day FROM fact WHERE alert_triggered)
        SELECT strftime(day, '%Y-%m-%d 00:00:00') AS window_start,
          strftime(day + INTERVAL 1 DAY, '%Y-%m-%d 00:00:00') AS window_end,
          court_district_code, alert_priority, count(*) AS alerts
        FROM closed WHERE day + INTERVAL 1 DAY <= (SELECT max(filed) FROM fact) - INTERVAL 2 DAY
        GROUP BY day, court_district_code, alert_priority""",
}

# versions of all that is known of a defendant, whatever the order of the loads
CHAINS = """
known AS (
  SELECT *, lag(attorney_status) OVER d AS was, lag(zip) OVER d AS was_zip, row_number() OVER d AS nth
  FROM cleaned WINDOW d AS (PARTITION BY defendant_id ORDER BY filed, hub_offset, hub_partition)
),
numbered AS (
  SELECT *, nth = 1 OR attorney_status IS DISTINCT FROM was OR zip IS DISTINCT FROM was_zip AS opens
  FROM known
),
placed AS (
  SELECT *, CAST(sum(CAST(opens AS INTEGER)) OVER d AS INTEGER) AS version
  FROM numbered WINDOW d AS (PARTITION BY defendant_id ORDER BY filed, hub_offset, hub_partition)
),
chains AS (
  SELECT defendant_id, attorney_status, zip, version, filed AS effective,
    lead(filed) OVER d AS ended, lead(version) OVER d IS NULL AS is_current
  FROM placed WHERE opens WINDOW d AS (PARTITION BY defendant_id ORDER BY version)
)"""
_CHAINS = _with(EVENTS, CLEAN, CHAINS)
SQL["versioned_dimension"] = f"""{_CHAINS} SELECT defendant_id, attorney_status,
  zip AS defendant_zip_code, {VERSION_COLUMNS} FROM chains"""
SQL["versioned_gold"] = f"""{_CHAINS} SELECT p.case_id, defendant_id, c.attorney_status,
  c.zip AS defendant_zip_code, {VERSION_COLUMNS}, CAST(1 AS INTEGER) AS case_version
  FROM placed p JOIN chains c USING (defendant_id, version)"""

# proceedings under what is known of their defendants today
_TODAY = _FACT.rstrip() + """,
today AS (
  SELECT f.* EXCLUDE (attorney_status), last.attorney_status, CAST(date_trunc('month', filed) AS DATE) AS month
  FROM fact f JOIN (
    SELECT defendant_id, attorney_status FROM cleaned QUALIFY row_number() OVER (
      PARTITION BY defendant_id ORDER BY filed DESC, hub_offset DESC, hub_partition DESC) = 1) last
  USING (defendant_id))
"""
_UPKEPT = f"""{GAP}, count(*) FILTER (WHERE alert_triggered) AS alerts,
  {MEAN_SCORE} AS avg_priority_score, {_money('sum(cost_cents)')} AS total_cost FROM today GROUP BY"""
for _name, _keys in {
    "upkept_gap": "court_district, court_district_code, charge_severity, income_level",
    "upkept_attorneys": "court_district_code, attorney_status",
    "upkept_demographics": "defendant_age_group, income_level, charge_type",
    "upkept_budget": "court_district, month, attorney_status",
}.items():
    SQL[_name] = f"{_TODAY} SELECT {_keys}, {_UPKEPT} {_keys}"

SQL["silver_without_position"] = f"""{_CLEAN}, told AS (
    SELECT *, {_hash('feed_key', 'lost')} % 50 = 0 AS lost, {_hash('feed_key', 'dup')} % 5 = 0 AS twice
    FROM cleaned)
  SELECT case_id, CASE WHEN NOT lost THEN hub_partition END AS eventhub_partition,
    CASE WHEN NOT lost THEN hub_offset END AS eventhub_offset, needs_representation FROM told
  UNION ALL SELECT case_id, NULL, NULL, needs_representation FROM told WHERE lost AND twice"""
SQL["silver_evolving"] = f"""{_CLEAN} SELECT case_id, hub_offset AS eventhub_offset, days_to_hearing,
  needs_representation, CASE WHEN {_hash('feed_key', 'v2')} % 2 = 1
    THEN 'R' || lpad(CAST({_hash('feed_key', 'room')} % 30 AS VARCHAR), 2, '0') END AS court_room FROM cleaned"""
SQL["case_history_full"] = f"""{_VERSIONS} SELECT c.case_id, c.defendant_id,
    {_text('c.filed', 'case_filed_date')}, {_text('c.hearing', 'hearing_date')}, v.attorney_status,
    {VERSION_COLUMNS}
  FROM cleaned c JOIN versions v ON c.defendant_id = v.defendant_id
    AND v.effective < c.hearing AND (v.ended IS NULL OR c.filed < v.ended)"""

# what the streams know in the end: their watermark is two days behind the slower of them
ALERTS = """
alerts AS (SELECT * FROM fact WHERE alert_triggered),
answers AS (
  SELECT defendant_id, filed AS answered FROM cleaned
  WHERE attorney_status IN ('Private Attorney', 'Public Defender Assigned'))"""
_ALERTS = _with(EVENTS, CLEAN, FACT, ALERTS)
SQL["stream_unanswered"] = f"""{_ALERTS} SELECT case_id, defendant_id, court_district_code,
    {_text('filed', 'eventhub_timestamp')}, CAST(score AS INTEGER) AS representation_priority_score,
    alert_priority
  FROM alerts a WHERE NOT EXISTS (
    SELECT 1 FROM answers b WHERE b.defendant_id = a.defendant_id
      AND b.answered BETWEEN a.filed AND a.filed + INTERVAL 48 HOUR)
  AND filed + INTERVAL 48 HOUR < least(
    (SELECT max(filed) FROM alerts), (SELECT max(answered) FROM answers)) - INTERVAL 2 DAY"""
SQL["stream_episodes"] = f"""{_ALERTS}, marked AS (
    SELECT *, CASE WHEN filed < lag(filed) OVER d + INTERVAL 7 DAY THEN 0 ELSE 1 END AS opens
    FROM alerts WINDOW d AS (PARTITION BY defendant_id ORDER BY filed)),
  numbered AS (
    SELECT *, sum(opens) OVER (PARTITION BY defendant_id ORDER BY filed, proceeding_sk) AS episode FROM marked)
  SELECT defendant_id, {_text('min(filed)', 'episode_begin')}, {_text('max(filed)', 'episode_end')},
    count(*) AS alerts, CAST(max(score) AS INTEGER) AS highest_score,
    CASE WHEN max(score) >= 9 THEN 'CRITICAL' ELSE 'HIGH' END AS highest_priority
  FROM numbered GROUP BY defendant_id, episode
  HAVING max(filed) + INTERVAL 7 DAY <= (SELECT max(filed) FROM alerts) - INTERVAL 2 DAY"""
SQL["stream_once"] = SQL["stream_dedupe"]

# later records of the cases, one per line of their order
UPDATES = f"""
later AS (
  SELECT DISTINCT l_orderkey AS feed_key,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS update_key FROM lineitem
),
updates AS (
  SELECT case_id, update_key, filed + to_seconds({_hash('update_key', 'later')} % 5184000) AS updated_at,
    {STATUSES}[{_hash('update_key', 'status')} % 5 + 1] AS status
  FROM later JOIN cleaned USING (feed_key)
  WHERE filed + to_seconds({_hash('update_key', 'later')} % 5184000) <= {AS_OF}
)"""
_UPDATES = _with(EVENTS, CLEAN, UPDATES)
SQL["case_status_changes"] = f"""{_UPDATES}, steps AS (
    SELECT *, lag(status) OVER c AS was, row_number() OVER c AS nth FROM updates
    WINDOW c AS (PARTITION BY case_id ORDER BY updated_at, update_key))
  SELECT case_id, was AS from_status, status AS to_status, {_text('updated_at', 'changed_at')}
  FROM steps WHERE nth > 1 AND was <> status"""
SQL["assignment_waits"] = f"""{_UPDATES.replace('WITH', 'WITH RECURSIVE', 1)}, waits AS (
    SELECT case_id, court_district_code, first IS NOT NULL AS assigned,
      CAST(epoch(coalesce(first, {AS_OF})) - epoch(filed) AS BIGINT) // 86400 AS days
    FROM cleaned LEFT JOIN (
      SELECT case_id, min(updated_at) AS first FROM updates
      WHERE status IN ('Private Attorney', 'Public Defender Assigned') GROUP BY case_id) USING (case_id)),
  daily AS (
    SELECT court_district_code, days, count(*) FILTER (WHERE assigned) AS assigned,
      count(*) FILTER (WHERE NOT assigned) AS censored FROM waits GROUP BY court_district_code, days),
  risk AS (
    SELECT *, row_number() OVER (PARTITION BY court_district_code ORDER BY days) AS k,
      CAST(sum(assigned + censored) OVER (PARTITION BY court_district_code ORDER BY days
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS at_risk FROM daily),
  shares AS (
    SELECT court_district_code, k, 1000000000 * (at_risk - assigned) // at_risk AS share FROM risk WHERE k = 1
    UNION ALL
    SELECT r.court_district_code, r.k, s.share * (r.at_risk - r.assigned) // r.at_risk
    FROM shares s JOIN risk r ON r.court_district_code = s.court_district_code AND r.k = s.k + 1)
  SELECT court_district_code, days, assigned, censored, at_risk, CAST(share AS BIGINT) AS waiting_billionths
  FROM risk JOIN shares USING (court_district_code, k)"""
SQL["capacity_cuts"] = f"""{_FACT}, lined AS (
    SELECT *, CAST(date_trunc('week', filed) AS DATE) AS week, CASE charge_severity
      WHEN 'Felony' THEN 12 WHEN 'Misdemeanor' THEN 6 ELSE 3 END AS hours FROM fact),
  used AS (
    SELECT *, CAST(sum(hours) OVER (
      PARTITION BY court_district, week ORDER BY score DESC, proceeding_sk) AS BIGINT) AS hours_used FROM lined)
  SELECT court_district, week, proceeding_sk, case_id, CAST(hours AS BIGINT) AS hours, hours_used,
    hours_used <= 400 AS within_capacity FROM used"""
SQL["change_points"] = f"""{_FACT}, weekly AS (
    SELECT court_district, CAST(date_trunc('week', filed) AS DATE) AS week, count(*) AS filings FROM fact
    WHERE NOT (filed < TIMESTAMP '2024-04-15' AND court_district_code = 'BX'
      AND {_hash('case_id', 'shift')} % 10 < 6)
    GROUP BY 1, 2),
  spans AS (SELECT court_district, min(week) AS low, max(week) AS high FROM weekly GROUP BY court_district),
  every AS (
    SELECT court_district, low AS first_week,
      CAST(unnest(generate_series(low, high, INTERVAL 7 DAY)) AS DATE) AS week FROM spans),
  filled AS (
    SELECT court_district, first_week, week, coalesce(filings, 0) AS filings,
      count(*) OVER (PARTITION BY court_district) AS weeks,
      sum(coalesce(filings, 0)) OVER (PARTITION BY court_district) AS total
    FROM every LEFT JOIN weekly USING (court_district, week)),
  summed AS (
    SELECT *, sum(weeks * filings - total) OVER d AS level FROM filled
    WINDOW d AS (PARTITION BY court_district ORDER BY week)),
  lowest AS (
    SELECT *, least(0, min(level) OVER d) AS low FROM summed
    WINDOW d AS (PARTITION BY court_district ORDER BY week)),
  best AS (
    SELECT * FROM lowest QUALIFY row_number() OVER (
      PARTITION BY court_district ORDER BY level - low DESC, week) = 1)
  SELECT court_district, CAST(coalesce(
      (SELECT max(l.week) FROM lowest l WHERE l.court_district = b.court_district AND l.week <= b.week
        AND l.level = b.low), first_week - 7) + 7 AS DATE) AS begins, week AS ends,
    CAST(level - low AS DOUBLE) / CAST(weeks AS DOUBLE) AS filings_above_mean
  FROM best b WHERE level > low"""


def _dependency(given: str, value: str) -> str:
    return f"""SELECT '{given} -> {value}' AS dependency, count(*) AS groups,
        count(*) FILTER (WHERE kinds > 1) AS broken_groups, CAST(sum(n) AS BIGINT) AS records,
        CAST(sum(n - most) AS BIGINT) AS records_to_remove FROM (
        SELECT {given}, sum(n) AS n, max(n) AS most, count(*) AS kinds FROM (
          SELECT {given}, {value}, count(*) AS n FROM told GROUP BY ALL) GROUP BY {given})"""


SQL["dependency_errors"] = f"""{_CLEAN}, told AS (
    SELECT case_id, court_district, court_district_code, defendant_id, income_level, assigned_judge FROM cleaned
    UNION ALL SELECT case_id, 'Bronx Criminal Court', court_district_code, defendant_id, income_level,
      assigned_judge FROM cleaned WHERE {_hash('case_id', 'moved')} % 25 = 0)
  """ + " UNION ALL ".join(_dependency(g, v) for g, v in (
    ("case_id", "court_district"), ("court_district", "court_district_code"),
    ("defendant_id", "income_level"), ("assigned_judge, court_district_code", "court_district")))
_TEXT_FIELDS = ("case_id defendant_id charge_type charge_severity case_status attorney_status defendant_gender "
                "income_level court_district assigned_judge hearing_type case_filed_date hearing_date "
                "record_timestamp").split()
SQL["schema_drift"] = f"""{_EVENTS}, kinds AS (
    SELECT filed, unnest({_TEXT_FIELDS}) AS field, 'text' AS kind FROM events_of_court
    UNION ALL SELECT filed, 'defendant_age', CASE WHEN {_hash('feed_key', 'badage')} % 30 = 0
      THEN 'text' ELSE 'integer' END FROM events_of_court WHERE defendant_age IS NOT NULL
    UNION ALL SELECT filed, 'defendant_zip_code', CASE WHEN {_hash('feed_key', 'badzip')} % 40 = 0
      THEN 'text' ELSE 'integer' END FROM events_of_court WHERE raw_zip IS NOT NULL)
  SELECT strftime(filed, '%Y-%m-%d') AS day, field, string_agg(DISTINCT kind, ',' ORDER BY kind) AS types,
    count(*) AS records, CAST(0 AS BIGINT) AS nulls, count(DISTINCT kind) > 1 AS conflicts
  FROM kinds GROUP BY 1, 2"""

# the copies in the feed leave no trace
SQL["silver_deduped"] = SQL["silver_clean"]
