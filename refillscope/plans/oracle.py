"""Reference SQL for every catalog query, runnable by DuckDB on the test tables.

Written independently of the Spark plans: plain window functions over whole keys,
the definitions stated directly. Conventions shared with the Spark side:
whole days are ``date_sub('day', a, b)``; the mean is rounded to 9 decimals and
then half-even; counts are BIGINT.
"""

from __future__ import annotations

_PRODUCTS = "('ECONOMY', 'PROMO', 'SMALL', 'LARGE')"

_BASE = """
base AS (
    SELECT p.p_type AS prod,
           o.o_custkey AS patient_id,
           CAST(o.o_orderdate AS TIMESTAMP) AS dispensed_at,
           CAST(l.l_quantity AS DOUBLE) AS qty,
           c.c_mktsegment AS sex,
           CAST(DATE '1930-01-01' + CAST((c.c_custkey * 37) % 25000 AS INTEGER) AS VARCHAR) AS birth_date,
           c.c_name AS birth_town,
           n.n_name AS residence_town,
           p.p_brand AS health_unit
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_DISP = f"""
disp AS (SELECT * FROM base WHERE prod IN {_PRODUCTS})"""


def _intervals(source: str) -> str:
    return f"""
ordered AS (
    SELECT prod, patient_id, dispensed_at, qty,
           ROW_NUMBER() OVER w AS rn,
           LAG(dispensed_at) OVER w AS prev_at,
           LAG(qty) OVER w AS prev_qty
    FROM {source}
    WINDOW w AS (PARTITION BY prod, patient_id ORDER BY dispensed_at ASC, qty ASC NULLS FIRST)
),
intervals AS (
    SELECT prod, patient_id,
           CASE WHEN rn = 1 THEN dispensed_at ELSE prev_at END AS base_at,
           CASE WHEN rn = 1 THEN NULL ELSE dispensed_at END AS next_at,
           CASE WHEN rn = 1 THEN qty ELSE prev_qty END AS qty,
           CAST(CASE WHEN rn = 1 THEN 0 ELSE date_sub('day', prev_at, dispensed_at) END AS BIGINT) AS gap_days,
           CAST(rn AS BIGINT) AS n
    FROM ordered
)"""


_ND = """
nd AS (
    SELECT *, CASE WHEN qty IS NULL OR qty = 0 THEN NULL ELSE gap_days / qty END AS normalised_days
    FROM intervals
)"""

_MEASURES = """
means AS (
    SELECT prod, patient_id,
           CAST(round_even(round(AVG(normalised_days), 9), 0) AS INTEGER) AS mean_days,
           CAST(COUNT(*) AS BIGINT) AS deliveries,
           MIN(next_or_base) AS first_at,
           MAX(next_or_base) AS last_at
    FROM (SELECT *, COALESCE(next_at, base_at) AS next_or_base FROM nd) t
    GROUP BY prod, patient_id
),
late AS (
    SELECT nd.prod, nd.patient_id,
           CAST(SUM(CASE WHEN nd.normalised_days > m.mean_days + 3 THEN 1 ELSE 0 END) AS BIGINT) AS late
    FROM nd JOIN means m ON nd.prod = m.prod AND nd.patient_id = m.patient_id
    GROUP BY nd.prod, nd.patient_id
)"""

_DEMO_ONE = """
demo AS (
    SELECT prod, patient_id, sex, birth_date, birth_town, residence_town, health_unit
    FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY prod, patient_id
            ORDER BY dispensed_at DESC, sex DESC NULLS LAST, birth_date DESC NULLS LAST,
                     birth_town DESC NULLS LAST, residence_town DESC NULLS LAST, health_unit DESC NULLS LAST
        ) AS pick
        FROM disp
    ) t
    WHERE pick = 1
)"""

_SUMMARY = """
summary AS (
    SELECT d.prod, d.patient_id, d.sex, d.birth_date, d.birth_town, d.residence_town, d.health_unit,
           m.first_at, m.last_at, m.mean_days, m.deliveries, l.late
    FROM demo d
    JOIN means m ON d.prod = m.prod AND d.patient_id = m.patient_id
    JOIN late l ON d.prod = l.prod AND d.patient_id = l.patient_id
)"""

_THERAPY = f"""
therapy AS (
    SELECT p.p_type AS prod,
           o.o_custkey AS patient_id,
           CAST(o.o_orderdate AS TIMESTAMP) AS dispensed_at,
           CAST(l.l_quantity - 1 AS DOUBLE) AS therapy_days
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    WHERE p.p_type IN {_PRODUCTS}
),
therapy_total AS (
    SELECT prod, patient_id, SUM(therapy_days) AS therapy_days_total
    FROM therapy GROUP BY prod, patient_id
),
therapy_last AS (
    SELECT prod, patient_id, therapy_days AS last_therapy_days
    FROM (
        SELECT *, ROW_NUMBER() OVER (
            PARTITION BY prod, patient_id ORDER BY dispensed_at DESC, therapy_days DESC NULLS LAST
        ) AS pick
        FROM therapy
    ) t
    WHERE pick = 1
)"""

_ADHERENCE = """
adh AS (
    SELECT s.prod, s.prod AS prod_desc, s.patient_id, s.sex, s.birth_date, s.birth_town, s.residence_town,
           s.health_unit, s.first_at, s.last_at, s.mean_days, s.deliveries, s.late,
           t.therapy_days_total,
           CAST(date_sub('day', s.first_at, s.last_at) AS DOUBLE) + tl.last_therapy_days AS denominator_days,
           lower(s.prod) AS slug, s.prod AS aic
    FROM summary s
    JOIN therapy_total t ON s.prod = t.prod AND s.patient_id = t.patient_id
    JOIN therapy_last tl ON s.prod = tl.prod AND s.patient_id = tl.patient_id
),
adherence AS (
    SELECT *, CASE WHEN denominator_days = 0 THEN NULL
                   ELSE round(therapy_days_total / denominator_days * 100, 2) END AS adherence_pct
    FROM adh
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_SUMMARY_CHAIN = (_BASE, _DISP, _intervals("disp"), _ND, _MEASURES, _DEMO_ONE, _SUMMARY)

_ADHERENCE_COLUMNS = (
    "prod, prod_desc, patient_id, sex, birth_date, birth_town, residence_town, health_unit, "
    "first_at, last_at, mean_days, deliveries, late, adherence_pct, therapy_days_total, denominator_days"
)

_EXPORT_SUMMARY = """
    CAST(patient_id AS VARCHAR) AS "CODICE PAZIENTE UNIVOCO",
    sex AS "SESSO",
    birth_date AS "DT_NAS",
    birth_town AS "COMUNE NASCITA",
    residence_town AS "COMUNE_RESIDENZA",
    health_unit AS "ASL_APPARTENENZA",
    strftime(first_at, '%d/%m/%Y') AS "DATA PRIMA CONSEGNA",
    strftime(last_at, '%d/%m/%Y') AS "DATA ULTIMA CONSEGNA",
    mean_days AS "MEDIA GIORNI",
    deliveries AS "NUMERO CONSEGNE TOTALI",
    late AS "NUMERO RITARDI\""""

_TEXT = """
lines AS (
    SELECT l.l_orderkey AS k, o.o_custkey, l.l_partkey, o.o_orderdate, l.l_quantity, p.p_brand,
           CASE WHEN l.l_orderkey % 89 = 0 THEN 'missing patient_id' WHEN l.l_orderkey % 79 = 0 THEN 'unusable prod'
                WHEN l.l_orderkey % 97 = 0 THEN 'unusable dispensed_at' WHEN l.l_orderkey % 83 = 0 THEN 'number' END AS reason
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
),
raw AS (
    SELECT *, CASE WHEN k % 89 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS raw_patient_id,
           CASE WHEN k % 79 = 0 THEN 'n/a' ELSE CAST(l_partkey AS VARCHAR) || '.0' END AS raw_prod,
           CASE WHEN k % 97 = 0 THEN '31/02/2022' WHEN k % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                ELSE strftime(o_orderdate, '%-d-%-m-%Y') END AS raw_dispensed_at
    FROM lines
)"""

# Every supplied day as a row of its own, then islands of consecutive days.
_COVERED = """
supply AS (SELECT prod, patient_id, CAST(dispensed_at AS DATE) AS from_day, CAST(therapy_days AS BIGINT) AS days FROM therapy WHERE therapy_days > 0),
covered AS (SELECT DISTINCT prod, patient_id, from_day + CAST(unnest(range(days)) AS INTEGER) AS day FROM supply),
numbered AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY prod, patient_id ORDER BY day) AS INTEGER) AS island FROM covered),
islands AS (
    SELECT prod, patient_id, min(day) AS from_day, max(day) AS to_day, count(*) AS days
    FROM numbered GROUP BY prod, patient_id, island
),
stretches AS (
    SELECT *, coalesce(from_day - lag(to_day) OVER (PARTITION BY prod, patient_id ORDER BY from_day) - 1, 0) AS gap_before
    FROM islands
)"""


_DAYS_COVERED = (
    _with(_THERAPY, _COVERED)
    + """, supplied AS (SELECT prod, patient_id, sum(days) AS days FROM supply GROUP BY prod, patient_id),
per_key AS (
    SELECT prod, patient_id, min(from_day) AS first_day, max(to_day) + 1 - min(from_day) AS span, sum(days) AS covered,
           sum(gap_before) AS gap_days, count(*) FILTER (gap_before > 0) AS gaps, max(gap_before) AS longest
    FROM stretches GROUP BY prod, patient_id
),
totals AS (
    SELECT p.prod, p.patient_id, p.first_day, CAST(span AS DOUBLE) AS span_days, CAST(covered AS DOUBLE) AS covered_days,
           CAST(s.days AS DOUBLE) AS supplied_days, CAST(s.days - covered AS DOUBLE) AS overlap_days,
           CAST(gap_days AS DOUBLE) AS gap_days, gaps, CAST(longest AS DOUBLE) AS longest_gap,
           round(CAST(covered AS DOUBLE) / CAST(span AS DOUBLE) * 100, 2) AS covered_pct
    FROM per_key p JOIN supplied s ON p.prod = s.prod AND p.patient_id = s.patient_id
)
"""
)

# Both versions of the text extract.
_VERSIONS = """
old AS (
    SELECT CAST(o_custkey AS VARCHAR) AS patient_id, l_partkey AS prod, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dispensed_at,
           CAST(l_quantity AS DOUBLE) AS qty, p_brand AS health_unit FROM raw WHERE reason IS NULL
),
new AS (
    SELECT CAST(o_custkey AS VARCHAR) AS patient_id, l_partkey AS prod, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dispensed_at,
           least(CAST(l_quantity AS DOUBLE), 45.0) AS qty, p_brand AS health_unit FROM raw WHERE k % 71 <> 0
),
changes AS (
    SELECT *, 'added' AS change, count(*) AS copies FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old) GROUP BY ALL
    UNION ALL
    SELECT *, 'removed' AS change, count(*) AS copies FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) GROUP BY ALL
)"""


def _in_force(compare: str) -> str:
    return (
        _with(_BASE, _DISP, _THERAPY)
        + f""", latest AS (
    SELECT prod, patient_id, dispensed_at AS therapy_at, max(therapy_days) AS therapy_days FROM therapy GROUP BY prod, patient_id, dispensed_at
)
SELECT d.prod, d.patient_id, d.dispensed_at, d.qty, t.therapy_at, t.therapy_days,
       date_sub('day', t.therapy_at, d.dispensed_at) AS days_since,
       CASE WHEN t.therapy_days IS NOT NULL
            THEN greatest(0.0, date_sub('day', t.therapy_at, d.dispensed_at) - t.therapy_days) END AS uncovered_days
FROM disp d ASOF LEFT JOIN latest t
  ON d.prod = t.prod AND d.patient_id = t.patient_id AND d.dispensed_at {compare} t.therapy_at"""
    )


ORACLE_SQL: dict[str, str] = {
    "days_covered": _DAYS_COVERED + "SELECT * FROM totals",
    "supply_stretches": _with(_THERAPY, _COVERED)
    + """SELECT t.prod, t.patient_id, t.from_day, CAST(any_value(t.days) AS DOUBLE) AS covered_days,
       CAST(sum(s.days) AS DOUBLE) AS supplied_days, count(*) AS supplies, CAST(any_value(t.gap_before) AS DOUBLE) AS gap_before
FROM stretches t JOIN supply s ON t.prod = s.prod AND t.patient_id = s.patient_id AND s.from_day BETWEEN t.from_day AND t.to_day
GROUP BY t.prod, t.patient_id, t.from_day""",
    "trailing_supply": _with(_THERAPY)
    + """, per_day AS (
    SELECT prod, patient_id, CAST(dispensed_at AS DATE) AS day, count(*) AS rows, sum(therapy_days) AS day_supply FROM therapy GROUP BY ALL
)
SELECT a.prod, a.patient_id, a.day, a.rows, a.day_supply, CAST(sum(b.rows) AS BIGINT) AS trailing_rows, sum(b.day_supply) AS trailing_supply
FROM per_day a JOIN per_day b ON a.prod = b.prod AND a.patient_id = b.patient_id AND b.day BETWEEN a.day - 89 AND a.day
GROUP BY a.prod, a.patient_id, a.day, a.rows, a.day_supply""",
    "coverage_quartiles": _DAYS_COVERED
    + """SELECT prod, patient_id, covered_pct, row_number() OVER w AS rank, count(*) OVER (PARTITION BY prod) AS group_rows,
       CAST(ntile(4) OVER w AS INTEGER) AS quartile
FROM totals WINDOW w AS (PARTITION BY prod ORDER BY covered_pct, patient_id)""",
    "top_late_patients": _with(_BASE, _DISP, _intervals("disp"), _ND, _MEASURES)
    + """SELECT m.prod, m.patient_id, m.mean_days, m.deliveries, l.late, CAST(row_number() OVER w AS INTEGER) AS place
FROM means m JOIN late l ON m.prod = l.prod AND m.patient_id = l.patient_id
WINDOW w AS (PARTITION BY m.prod ORDER BY l.late DESC, m.mean_days DESC, m.patient_id) QUALIFY place <= 10""",
    "adherence_cube": _with(*_SUMMARY_CHAIN, _THERAPY, _ADHERENCE)
    + """SELECT prod, health_unit, sex, grouping(prod, health_unit, sex) AS level, count(*) AS patients,
       CAST(sum(deliveries) AS BIGINT) AS deliveries, CAST(sum(late) AS BIGINT) AS late,
       round(CAST(sum(late) AS DOUBLE) / sum(deliveries) * 100, 2) AS late_pct,
       CASE WHEN sum(denominator_days) <> 0 THEN round(sum(therapy_days_total) / sum(denominator_days) * 100, 2) END AS adherence_pct
FROM adherence GROUP BY CUBE (prod, health_unit, sex)""",
    "extract_changes": _with(_TEXT, _VERSIONS) + "SELECT * FROM changes",
    "extract_change_report": _with(_TEXT, _VERSIONS)
    + """, sides AS (
    SELECT patient_id, prod, dispensed_at, coalesce(sum(copies) FILTER (change = 'added'), 0) AS came,
           coalesce(sum(copies) FILTER (change = 'removed'), 0) AS went
    FROM changes GROUP BY ALL
)
SELECT patient_id, prod, dispensed_at, CAST(greatest(came - went, 0) AS BIGINT) AS added,
       CAST(greatest(went - came, 0) AS BIGINT) AS removed, CAST(least(came, went) AS BIGINT) AS changed FROM sides""",
    "extract_patients": _with(_TEXT, _VERSIONS)
    + """SELECT coalesce(o.prod, n.prod) AS prod, coalesce(o.patient_id, n.patient_id) AS patient_id, coalesce(o.lines, 0) AS old_lines,
       coalesce(n.lines, 0) AS new_lines, CASE WHEN o.lines IS NULL THEN 'only_new' WHEN n.lines IS NULL THEN 'only_old' ELSE 'both' END AS presence
FROM (SELECT prod, patient_id, count(*) AS lines FROM old GROUP BY ALL) o
FULL JOIN (SELECT prod, patient_id, count(*) AS lines FROM new GROUP BY ALL) n ON o.prod = n.prod AND o.patient_id = n.patient_id""",
    "therapy_in_force": _in_force(">="),
    "therapy_before_delivery": _in_force(">"),
    "dispensing_text_typed": _with(_TEXT)
    + "SELECT CAST(o_custkey AS VARCHAR) AS patient_id, l_partkey AS prod, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dispensed_at, "
    "CAST(l_quantity AS DOUBLE) AS qty, CAST(NULL AS VARCHAR) AS sex, CAST(NULL AS VARCHAR) AS birth_date, "
    "CAST(NULL AS VARCHAR) AS birth_town, CAST(NULL AS VARCHAR) AS residence_town, p_brand AS health_unit FROM raw WHERE reason IS NULL",
    "therapy_text_typed": _with(_TEXT)
    + "SELECT CAST(o_custkey AS VARCHAR) AS patient_id, l_partkey AS prod, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS dispensed_at, "
    "CAST(l_quantity AS DOUBLE) / 2 AS therapy_days FROM raw WHERE reason IS NULL",
    "ingest_rejects": _with(_TEXT)
    + """SELECT 'dispensing' AS extract, CASE reason WHEN 'number' THEN 'unusable qty' ELSE reason END AS reason, raw_patient_id, raw_prod,
    raw_dispensed_at, CASE WHEN k % 83 = 0 THEN '1x' ELSE CAST(CAST(l_quantity AS DOUBLE) AS VARCHAR) END AS raw_number
    FROM raw WHERE reason IS NOT NULL
    UNION ALL
    SELECT 'therapy', CASE reason WHEN 'number' THEN 'unusable therapy_days' ELSE reason END, raw_patient_id, raw_prod, raw_dispensed_at,
    CASE WHEN k % 83 = 0 THEN '1,5,5' ELSE replace(CAST(CAST(l_quantity AS DOUBLE) / 2 AS VARCHAR), '.', ',') END
    FROM raw WHERE reason IS NOT NULL""",
    "dispensing_typed": _with(_BASE) + "SELECT * FROM base",
    "product_filter": _with(_BASE, _DISP) + "SELECT * FROM disp",
    "delivery_intervals": _with(_BASE, _DISP, _intervals("disp")) + "SELECT * FROM intervals",
    "normalised_days": _with(_BASE, _DISP, _intervals("disp"), _ND) + "SELECT * FROM nd",
    "average_days": _with(_BASE, _DISP, _intervals("disp"), _ND, _MEASURES)
    + "SELECT prod, patient_id, mean_days FROM means",
    "late_deliveries": _with(_BASE, _DISP, _intervals("disp"), _ND, _MEASURES) + "SELECT * FROM late",
    "delivery_count": _with(_BASE, _DISP)
    + "SELECT prod, patient_id, CAST(COUNT(*) AS BIGINT) AS deliveries FROM disp GROUP BY prod, patient_id",
    "delivery_measures": _with(_BASE, _DISP, _intervals("disp"), _ND, _MEASURES)
    + "SELECT m.prod, m.patient_id, m.mean_days, m.deliveries, l.late FROM means m "
    "JOIN late l ON m.prod = l.prod AND m.patient_id = l.patient_id",
    "first_last_delivery": _with(_BASE, _DISP)
    + "SELECT prod, patient_id, MIN(dispensed_at) AS first_at, MAX(dispensed_at) AS last_at "
    "FROM disp GROUP BY prod, patient_id",
    "patient_demographics": _with(_BASE, _DISP)
    + "SELECT DISTINCT prod, patient_id, sex, birth_date, birth_town, residence_town, health_unit FROM disp",
    "demographics_one_row": _with(_BASE, _DISP, _DEMO_ONE) + "SELECT * FROM demo",
    "delivery_summary": _with(*_SUMMARY_CHAIN) + "SELECT * FROM summary",
    "therapy_typed": _with(_THERAPY) + "SELECT prod, patient_id, dispensed_at, therapy_days FROM therapy",
    "therapy_days_total": _with(_THERAPY) + "SELECT * FROM therapy_total",
    "last_therapy_days": _with(_THERAPY) + "SELECT * FROM therapy_last",
    "adherence": _with(*_SUMMARY_CHAIN, _THERAPY, _ADHERENCE)
    + f"SELECT {_ADHERENCE_COLUMNS}, slug, aic FROM adherence",
    "adherence_consolidated": _with(*_SUMMARY_CHAIN, _THERAPY, _ADHERENCE)
    + f"SELECT {_ADHERENCE_COLUMNS} FROM adherence",
    "delivery_summary_export": _with(*_SUMMARY_CHAIN)
    + f"SELECT {_EXPORT_SUMMARY}, prod AS \"AIC\", lower(prod) AS slug FROM summary",
    "adherence_export": _with(*_SUMMARY_CHAIN, _THERAPY, _ADHERENCE)
    + f"""SELECT CAST(prod AS VARCHAR) AS "PROD", prod_desc AS "PROD_DESC", {_EXPORT_SUMMARY},
    CASE WHEN denominator_days = 0 THEN '0000' ELSE CAST(adherence_pct AS VARCHAR) END AS "ADERENZA",
    therapy_days_total AS "NUMERATORE ADERENZA(GIORNI DI TERAPIA)",
    denominator_days AS "DENOMINATORE ADERENZA(NUM GIORNI TRA PRIMA E ULTIMA CONSEGNA)",
    aic AS "AIC", slug
    FROM adherence""",
    "event_intervals": """WITH
events_d AS (
    SELECT event_type AS prod, user_id AS patient_id, CAST(ts AS TIMESTAMP) AS dispensed_at,
           CAST(value AS DOUBLE) AS qty
    FROM events
),"""
    + _intervals("events_d")
    + "\nSELECT * FROM intervals",
}

_ARRIVALS = f"""
WITH {_BASE.strip()}, {_DISP.strip()},
arrived AS (
    SELECT prod, patient_id, dispensed_at, qty,
           CASE WHEN patient_id % 97 = 0 OR dispensed_at >= TIMESTAMP '1999-01-01' THEN 2
                WHEN dispensed_at >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END AS arrival
    FROM disp
),
marks AS (
    SELECT a.arrival, (SELECT max(b.dispensed_at) FROM arrived b WHERE b.arrival < a.arrival) - INTERVAL 30 DAY AS mark
    FROM (SELECT DISTINCT arrival FROM arrived) a
),
judged AS (
    SELECT arrived.*,
           CASE WHEN qty IS NULL OR NOT qty BETWEEN 1 AND 36500 THEN 'no_supply'
                WHEN dispensed_at <= mark THEN 'late' ELSE 'admitted' END AS outcome
    FROM arrived JOIN marks USING (arrival)
)"""

ORACLE_SQL |= {
    "streamed_admission": f"""{_ARRIVALS}
SELECT CAST(arrival AS BIGINT) AS arrival, outcome, count(*) AS rows FROM judged GROUP BY ALL
""",
    "streamed_sessions": f"""{_ARRIVALS},
supplies AS (
    SELECT prod, patient_id, dispensed_at, count(*) AS rows, sum(floor(qty)) AS days,
           max(dispensed_at + (CAST(floor(qty) AS BIGINT) + 30) * INTERVAL 1 DAY) AS ends
    FROM judged WHERE outcome = 'admitted' GROUP BY prod, patient_id, dispensed_at
),
follows AS (
    SELECT *, max(ends) OVER (PARTITION BY prod, patient_id ORDER BY dispensed_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
    FROM supplies
),
numbered AS (
    SELECT *, sum(CASE WHEN dispensed_at <= before THEN 0 ELSE 1 END)
                  OVER (PARTITION BY prod, patient_id ORDER BY dispensed_at ROWS UNBOUNDED PRECEDING) AS session
    FROM follows
)
SELECT prod, patient_id, min(dispensed_at) AS session_start, max(ends) AS session_end, CAST(sum(rows) AS BIGINT) AS deliveries,
       CAST(sum(days) AS BIGINT) AS supplied_days, max(dispensed_at) AS last_delivery
FROM numbered GROUP BY prod, patient_id, session
HAVING max(ends) < (SELECT max(dispensed_at) FROM supplies) - INTERVAL 30 DAY
""",
}
