"""DuckDB twins of the report-level queries (C8-C17 bindings).

Dates are the binding constants of ``views`` written out: SCORE = 1996-12-16,
so yesterday = 12-15, month-to-date = 12-01..12-15, last month = 11-01..11-15;
best months Jan..Nov 1996; 12 of December's 26 working days have passed.
"""

from __future__ import annotations

from planpulse.bindings.oracle import ELIGIBLE, LAST_PLAN, VIEWS, _CYCLE, _visits_c5, in_force, plan_types, timeline


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean(x: str) -> str:
    s = strip(x)
    return (f"CASE WHEN {s} IS NULL OR lower({s}) IN ('', 'none', 'nan') THEN NULL "
            f"ELSE regexp_replace({s}, '\\s+', ' ', 'g') END")


def canon(x: str, alias: str) -> str:
    return f"CASE WHEN {alias}.tech_name IS NOT NULL THEN NULLIF({strip(alias + '.final_name')}, '') ELSE {clean(x)} END"


def branch(x: str) -> str:
    b = strip(f"COALESCE({x}, 'Unknown')")
    return f"CASE WHEN {b} = 'MIDDLE EAST' THEN 'MIDEAST' ELSE {b} END"


# The cycle without the timeline, which the report views already have.
_CYCLE_REST = "\n" + _CYCLE[_CYCLE.index("cycle AS ("):]

MESSY = "'  ' || replace(s_name, '#', '  #') || ' '"

REPORT_VIEWS = f"""
staff_raw AS (SELECT s_suppkey AS staff_id, {MESSY} AS staff_raw FROM supplier),
alias AS (SELECT DISTINCT replace(s_name, '#', ' #') AS tech_name,
                 CASE WHEN s_nationkey = 0 THEN '' ELSE 'Team ' || CAST(s_nationkey AS VARCHAR) END AS final_name
          FROM supplier WHERE s_nationkey < 3),
{ELIGIBLE.strip()},
{in_force("1996-01-01", "1996-12-16").strip()},
{LAST_PLAN.strip()},
owned AS (
  SELECT p.plan_id, p.due_date, {branch('e.branch')} AS branch, oa.staff_raw AS owner_a_name, ob.staff_raw AS owner_b_name
  FROM plans p LEFT JOIN entities e ON e.entity_id = p.entity_id
  LEFT JOIN staff_raw oa ON oa.staff_id = p.owner_a LEFT JOIN staff_raw ob ON ob.staff_id = p.owner_b),
c1 AS (SELECT f.active_date, o.* FROM in_force f JOIN owned o USING (plan_id)),
c2 AS (SELECT o.*, o.due_date + 1 AS inactive_date, o.branch AS rbranch FROM last_plan JOIN owned o USING (plan_id)
       WHERE o.due_date < DATE '1996-12-16'),
{plan_types("1995-12-01").strip()},
c4 AS (SELECT * REPLACE ({branch('branch')} AS branch) FROM typed),
{_visits_c5("1996-12-16").strip()},
c5r AS (SELECT c5.*, {branch('c5.entity_branch')} AS branch, s.staff_raw
        FROM c5 LEFT JOIN staff_raw s ON s.staff_id = c5.staff_id),
assess AS (
  SELECT CAST(CAST(ev.ts AS DATE) - to_months(CAST(325 + ev.event_id % 3 AS INTEGER)) AS DATE) AS date, r.r_name AS center,
         CAST(1 + ev.event_id % 3 AS DOUBLE) AS assess_no, CAST(ev.value AS DECIMAL(18,2)) AS cost
  FROM events ev LEFT JOIN region r ON r.r_regionkey = ev.user_id % 5
  WHERE ev.event_type = 'purchase'),
facts AS (
  SELECT branch, visit_date AS day, CAST(NULL AS DATE) AS month,
         CASE opd_status WHEN 'NEW OPD' THEN 'New OPDs' WHEN 'OLD OPD' THEN 'F/U OPDs' END AS metric,
         1.0 AS n,
         CASE WHEN COALESCE(TRY_CAST(amount AS DECIMAL(18,2)), 0) = 0 THEN CAST(1500 AS DECIMAL(18,2))
              ELSE TRY_CAST(amount AS DECIMAL(18,2)) END AS amount, TRUE AS listed
  FROM c5r
  UNION ALL SELECT branch, visit_date, NULL, 'Suggest RPP', 1.0, NULL, TRUE FROM c5r WHERE is_suggest = 'Yes'
  UNION ALL SELECT branch, start_date, NULL,
         CASE plan_type WHEN 'New Plan' THEN 'New Plan' WHEN 'Renewal' THEN 'Renewals' WHEN 'Revival' THEN 'Revivals' END,
         1.0, COALESCE(TRY_CAST(amount AS DECIMAL(18,2)), 0), TRUE FROM c4
  UNION ALL SELECT rbranch, inactive_date, NULL, 'Inactive', 1.0, NULL, TRUE FROM c2
  UNION ALL SELECT branch, NULL, active_date, 'Active', 1.0, NULL, TRUE FROM c1
  UNION ALL SELECT center, date, NULL, 'Assessments', assess_no, cost, FALSE FROM assess),
scopes AS (
  SELECT DISTINCT branch AS scope FROM facts
  WHERE listed AND branch IS NOT NULL AND branch <> '' AND branch <> 'Unknown'
  UNION SELECT 'Overall'),
metric_list AS (SELECT * FROM (VALUES ('New OPDs', 1), ('F/U OPDs', 1), ('New Plan', 1), ('Renewals', 1),
                                      ('Revivals', 1), ('Inactive', 0), ('Active', 0), ('Assessments', 1),
                                      ('Suggest RPP', 0)) v(metric, has_amount))
"""


def _metric_table(periods_cte: str, tag_join: str) -> str:
    """Long (scope, period, metric, value, amount) over a periods CTE named ``periods``."""
    return f"""
{periods_cte},
tagged AS (SELECT f.*, p.period FROM facts f JOIN periods p ON {tag_join}),
vals AS (
  SELECT branch AS scope, period, metric, SUM(n) AS value, SUM(amount) AS amount FROM tagged GROUP BY ALL
  UNION ALL
  SELECT 'Overall', period, metric, SUM(n), SUM(amount) FROM tagged GROUP BY ALL),
grid AS (
  SELECT s.scope, p.period, m.metric, COALESCE(v.value, 0.0) AS value,
         CASE WHEN m.has_amount = 1 THEN COALESCE(v.amount, 0) END AS amount
  FROM scopes s CROSS JOIN (SELECT DISTINCT period FROM periods) p CROSS JOIN metric_list m
  LEFT JOIN vals v ON v.scope = s.scope AND v.period = p.period AND v.metric = m.metric),
per AS (
  SELECT scope, period,
         SUM(CASE WHEN metric = 'New Plan' THEN value END) AS np,
         SUM(CASE WHEN metric = 'New OPDs' THEN value END) AS no,
         SUM(CASE WHEN metric IN ('New OPDs','F/U OPDs','New Plan','Renewals','Revivals','Assessments')
                  THEN amount END) AS rev
  FROM grid GROUP BY scope, period),
metrics AS (
  SELECT scope, period, metric, value, CAST(amount AS DOUBLE) AS amount FROM grid
  UNION ALL
  SELECT scope, period, 'NO2P %', CASE WHEN COALESCE(no, 0) = 0 THEN 0.0
                                       ELSE round_even(COALESCE(np, 0) / no * 100, 1) END, NULL FROM per
  UNION ALL
  SELECT scope, period, 'Revenue', CAST(COALESCE(rev, 0) AS DOUBLE), CAST(COALESCE(rev, 0) AS DOUBLE) FROM per)
"""


PERIODS = """
periods AS (SELECT * FROM (VALUES
  ('yesterday', DATE '1996-12-15', DATE '1996-12-15', DATE '1996-12-01'),
  ('mtd', DATE '1996-12-01', DATE '1996-12-15', DATE '1996-12-01'),
  ('last_month', DATE '1996-11-01', DATE '1996-11-15', DATE '1996-11-01')) v(period, d1, d2, m))"""
PERIOD_JOIN = "(f.metric = 'Active' AND f.month = p.m) OR (f.metric <> 'Active' AND f.day BETWEEN p.d1 AND p.d2)"

BEST_PERIODS = """
months AS (SELECT CAST(g AS DATE) AS m FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-11-01', INTERVAL 1 MONTH) t(g)),
wdays AS (
  SELECT m, d, ROW_NUMBER() OVER (PARTITION BY m ORDER BY d) AS k
  FROM (SELECT m, CAST(unnest(generate_series(CAST(m AS TIMESTAMP), CAST(last_day(m) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM months) z
  WHERE dayofweek(d) <> 0),
span_end AS (SELECT m, COALESCE(MAX(CASE WHEN k = 12 THEN d END), MAX(d)) AS e FROM wdays GROUP BY m),
periods AS (
  SELECT strftime(m.m, '%Y-%m-%d') || '|full' AS period, m.m, m.m AS d1, last_day(m.m) AS d2 FROM months m
  UNION ALL
  SELECT strftime(m.m, '%Y-%m-%d') || '|same', m.m, m.m, s.e FROM months m JOIN span_end s ON s.m = m.m)"""

BEST_BODY = _metric_table(BEST_PERIODS, PERIOD_JOIN) + """,
best AS (
  SELECT scope, metric, split_part(period, '|', 2) AS span, value,
         CAST(split_part(period, '|', 1) AS DATE) AS month,
         ROW_NUMBER() OVER (PARTITION BY scope, metric, split_part(period, '|', 2)
                            ORDER BY value DESC, split_part(period, '|', 1)) AS rn
  FROM metrics WHERE metric <> 'Revenue'),
best1 AS (
  SELECT scope, metric, span, GREATEST(value, 0.0) AS best_value,
         CASE WHEN value > 0 THEN month END AS best_month,
         CASE WHEN value > 0 THEN strftime(month, '%b-%y') ELSE '' END AS best_label
  FROM best WHERE rn = 1)
"""

TARGETS = """
targets AS (SELECT * FROM (VALUES
  ('Overall', 'New OPDs', 40), ('Overall', 'New Plan', 6), ('Overall', 'Revivals', 0),
  ('Overall', 'Revenue', 2000000), ('AMERICA', 'New OPDs', 8), ('ASIA', 'F/U OPDs', 30),
  ('EUROPE', 'Inactive', 5), ('AFRICA', 'Revenue', 0)) v(scope, category, target))"""


def _r(body: str) -> str:
    return "WITH " + VIEWS.strip() + ",\n" + REPORT_VIEWS.strip() + body


PERIOD_METRICS = _r("," + _metric_table(PERIODS, PERIOD_JOIN) + """
SELECT scope, period, metric, value, amount FROM metrics
""")

_WIDE = """,
wide AS (
  SELECT scope, metric,
         MAX(CASE WHEN period = 'yesterday' THEN value END) AS yesterday,
         MAX(CASE WHEN period = 'mtd' THEN value END) AS mtd,
         MAX(CASE WHEN period = 'last_month' THEN value END) AS last_month,
         MAX(CASE WHEN period = 'mtd' THEN amount END) AS amt
  FROM metrics GROUP BY scope, metric),
lm_active AS (SELECT scope, value AS lm FROM metrics WHERE period = 'last_month' AND metric = 'Active'),
tgt AS (
  SELECT w.*, CASE WHEN w.metric = 'Renewals' THEN CAST(round_even(COALESCE(a.lm, 0) * 0.75, 0) AS BIGINT)
                   WHEN w.metric = 'Revenue' AND t.target = 0 THEN NULL
                   ELSE CAST(t.target AS BIGINT) END AS target
  FROM wide w LEFT JOIN lm_active a ON a.scope = w.scope
  LEFT JOIN targets t ON t.scope = w.scope AND t.category = w.metric)
"""

SCORECARD_CHANGE = _r("," + _metric_table(PERIODS, PERIOD_JOIN) + "," + TARGETS + _WIDE + """,
chg AS (
  SELECT tgt.*,
    CASE WHEN metric = 'NO2P %' THEN
           CASE WHEN mtd = 0 AND last_month = 0 THEN NULL
                WHEN abs(round_even(mtd - last_month, 1)) < 0.05 THEN 0.0
                ELSE abs(round_even(mtd - last_month, 1)) END
         WHEN last_month = 0 THEN NULL
         WHEN abs((mtd - last_month) / last_month * 100) < 0.05 THEN 0.0
         ELSE abs(round_even((mtd - last_month) / last_month * 100, 1)) END AS change_pct,
    CASE WHEN metric = 'NO2P %' THEN
           CASE WHEN mtd = 0 AND last_month = 0 THEN 'none'
                WHEN abs(round_even(mtd - last_month, 1)) < 0.05 THEN 'flat'
                WHEN mtd > last_month THEN 'up' ELSE 'down' END
         WHEN last_month = 0 AND mtd = 0 THEN 'none'
         WHEN last_month = 0 THEN 'new'
         WHEN abs((mtd - last_month) / last_month * 100) < 0.05 THEN 'flat'
         WHEN mtd > last_month THEN 'up' ELSE 'down' END AS direction
  FROM tgt)
SELECT scope, metric, yesterday, mtd, last_month, change_pct, direction,
       CASE WHEN direction IN ('none', 'flat') THEN 'none'
            WHEN metric = 'NO2P %' THEN CASE WHEN direction = 'up' THEN 'good' ELSE 'bad' END
            WHEN direction IN ('up', 'new') THEN CASE WHEN metric = 'Inactive' THEN 'bad' ELSE 'good' END
            ELSE CASE WHEN metric = 'Inactive' THEN 'good' ELSE 'bad' END END AS signal,
       CASE WHEN metric IN ('New OPDs','F/U OPDs','New Plan','Renewals','Revivals','Assessments','Revenue')
            THEN amt END AS amount,
       target,
       CASE WHEN target IS NULL THEN NULL WHEN target = 0 THEN 0.0
            ELSE round_even(mtd / target * 100, 1) END AS attained,
       CASE WHEN target IS NULL THEN NULL
            ELSE round_even(GREATEST(0.0, 100.0 - CASE WHEN target = 0 THEN 0.0
                                                       ELSE round_even(mtd / target * 100, 1) END), 1) END AS pending,
       CASE WHEN target IS NULL THEN NULL ELSE mtd >= target END AS met
FROM chg
""")

BEST_PERIOD = _r("," + BEST_BODY + """
SELECT scope, metric, span, best_value, best_month, best_label FROM best1
""")

TARGET_VS_ACHIEVED = _r("," + BEST_BODY.replace("metrics", "bmetrics").replace(
    "periods", "bperiods").replace("tagged", "btagged").replace("vals", "bvals").replace(
    "grid", "bgrid").replace(" per ", " bper ").replace("FROM per", "FROM bper").replace(
    "per AS", "bper AS").replace("months", "bmonths").replace("wdays", "bwdays").replace(
    "span_end", "bspan_end") + "," + _metric_table(PERIODS, PERIOD_JOIN) + "," + TARGETS + _WIDE + """
SELECT t.scope, t.metric, t.target,
       CASE WHEN t.target IS NOT NULL THEN CAST(round_even(t.target * 12::DOUBLE / 26, 0) AS BIGINT) END AS prorated_target,
       COALESCE(b.best_value, 0.0) AS best_value, COALESCE(b.best_label, '') AS best_label,
       t.mtd AS achieved,
       CASE WHEN t.target IS NOT NULL THEN t.mtd >= round_even(t.target * 12::DOUBLE / 26, 0) END AS met
FROM tgt t LEFT JOIN best1 b ON b.scope = t.scope AND b.metric = t.metric AND b.span = 'same'
WHERE t.metric NOT IN ('NO2P %', 'Revenue')
""")

BRANCH_METRIC_TABLE = _r("," + BEST_BODY.replace("metrics", "bmetrics").replace(
    "periods", "bperiods").replace("tagged", "btagged").replace("vals", "bvals").replace(
    "grid", "bgrid").replace(" per ", " bper ").replace("FROM per", "FROM bper").replace(
    "per AS", "bper AS").replace("months", "bmonths").replace("wdays", "bwdays").replace(
    "span_end", "bspan_end") + "," + _metric_table(PERIODS, PERIOD_JOIN) + """,
m AS (
  SELECT scope, metric, value AS achieved FROM metrics
  WHERE period = 'mtd' AND metric IN ('New OPDs','F/U OPDs','Suggest RPP','New Plan','Renewals',
                                      'Revivals','Assessments','Active','Inactive')),
mb AS (SELECT m.*, sp.span, coalesce(b.best_value, 0.0) AS best_value, coalesce(b.best_label, '') AS best_label
       FROM m CROSS JOIN (VALUES ('same'), ('full')) sp(span)
       LEFT JOIN best1 b ON (b.scope, b.metric, b.span) = (m.scope, m.metric, sp.span)),
mt AS (FROM mb UNION ALL BY NAME
       SELECT 'Total' AS scope, metric, span, SUM(achieved) AS achieved, SUM(best_value) AS best_value, '' AS best_label
       FROM mb WHERE scope <> 'Overall' GROUP BY metric, span)
SELECT scope, metric, span, achieved, best_value, best_label,
       CAST(CASE WHEN best_value > 0 THEN round_even(achieved / best_value * 100, 0) ELSE 0 END AS BIGINT) AS attainment_pct
FROM mt
""")

_STAFF = """,
c3t AS (SELECT * FROM kept_cycle WHERE start_date >= DATE '1995-12-01' AND start_date <= DATE '1996-12-16'),
vis AS (SELECT c5r.*, {canon_v} AS staff FROM c5r LEFT JOIN alias av ON av.tech_name = {clean_v}),
vm AS (SELECT staff, CAST(COUNT(*) FILTER (WHERE opd_status = 'NEW OPD') AS BIGINT) AS new_visits,
              CAST(COUNT(*) FILTER (WHERE opd_status = 'OLD OPD') AS BIGINT) AS followup_visits,
              CAST(COUNT(*) FILTER (WHERE is_suggest = 'Yes') AS BIGINT) AS suggested
       FROM vis WHERE visit_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15' AND staff IS NOT NULL
       GROUP BY staff),
cm AS (SELECT staff, CAST(COUNT(DISTINCT entity_id) AS BIGINT) AS conversions FROM vis
       WHERE opd_status = 'NEW OPD' AND visit_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15'
         AND staff IS NOT NULL
         AND entity_id IN (SELECT entity_id FROM c3t WHERE plan_status = 'NEW PLAN'
                           AND start_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15')
       GROUP BY staff),
sess AS (
  SELECT r.slot_date, r.staff_id, COUNT(*) AS total_sessions
  FROM roster r
  LEFT JOIN (SELECT DISTINCT ON (roster_id) roster_id, map_entity FROM roster ORDER BY roster_id, map_entity) mm
    ON r.roster_id = mm.roster_id
  LEFT JOIN entities e ON e.entity_id = mm.map_entity
  WHERE r.booked = 1 AND r.is_active = 1 AND r.task = 'click'
    AND r.slot_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-16'
  GROUP BY r.slot_date, r.task, r.is_active, r.booked, r.staff_id, e.entity_id, e.branch, e.name,
           e.contact, e.csr_id, e.source),
smap AS (SELECT s.staff_id, {canon_s} AS staff FROM staff_raw s LEFT JOIN alias a2 ON a2.tech_name = {clean_s}),
sm AS (SELECT smap.staff, CAST(SUM(total_sessions) AS BIGINT) AS sessions FROM sess JOIN smap ON smap.staff_id = sess.staff_id
       WHERE sess.slot_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15' AND smap.staff IS NOT NULL
       GROUP BY smap.staff),
roles_a AS (SELECT owner_a_name AS raw FROM c1 WHERE active_date = DATE '1996-12-01'
            UNION ALL SELECT owner_b_name FROM c1 WHERE active_date = DATE '1996-12-01'),
am AS (SELECT {canon_r} AS staff, CAST(COUNT(*) AS BIGINT) AS active
       FROM roles_a LEFT JOIN alias a3 ON a3.tech_name = {clean_r}
       WHERE {canon_r} IS NOT NULL GROUP BY 1),
roles_i AS (SELECT owner_a_name AS raw FROM c2 WHERE inactive_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15'
            UNION ALL SELECT owner_b_name FROM c2 WHERE inactive_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15'),
im AS (SELECT {canon_r} AS staff, CAST(COUNT(*) AS BIGINT) AS inactive
       FROM roles_i LEFT JOIN alias a3 ON a3.tech_name = {clean_r}
       WHERE {canon_r} IS NOT NULL GROUP BY 1),
names AS (SELECT staff FROM vm UNION SELECT staff FROM cm UNION SELECT staff FROM sm
          UNION SELECT staff FROM am UNION SELECT staff FROM im),
card AS (
  SELECT n.staff, COALESCE(vm.new_visits, 0) AS new_visits, COALESCE(vm.followup_visits, 0) AS followup_visits,
         COALESCE(vm.new_visits, 0) + COALESCE(vm.followup_visits, 0) AS total_visits,
         COALESCE(vm.suggested, 0) AS suggested, COALESCE(cm.conversions, 0) AS conversions,
         COALESCE(sm.sessions, 0) AS sessions, COALESCE(am.active, 0) AS active,
         COALESCE(im.inactive, 0) AS inactive
  FROM names n
  LEFT JOIN vm ON vm.staff = n.staff LEFT JOIN cm ON cm.staff = n.staff LEFT JOIN sm ON sm.staff = n.staff
  LEFT JOIN am ON am.staff = n.staff LEFT JOIN im ON im.staff = n.staff
  WHERE n.staff IS NOT NULL)
""".format(canon_v=canon("c5r.staff_raw", "av"), clean_v=clean("c5r.staff_raw"),
           canon_s=canon("s.staff_raw", "a2"), clean_s=clean("s.staff_raw"),
           canon_r=canon("raw", "a3"), clean_r=clean("raw"))

STAFF_SCORECARD = _r("," + _CYCLE_REST + _STAFF + """
SELECT * FROM card
""")

_FLAG_METRICS = ("new_visits", "followup_visits", "total_visits", "suggested", "conversions",
                 "sessions", "active", "inactive")


def _flag(c: str) -> str:
    hi = f"MAX(CASE WHEN {c} <> 0 THEN {c} END) OVER ()"
    lo = f"MIN(CASE WHEN {c} <> 0 THEN {c} END) OVER ()"
    good, bad = (lo, hi) if c == "inactive" else (hi, lo)
    return (f"CASE WHEN {c} <> 0 AND {c} = {good} THEN 'best' "
            f"WHEN {c} <> 0 AND {c} = {bad} AND {hi} <> {lo} THEN 'worst' END AS {c}_flag")


EXTREME_FLAGS = _r("," + _CYCLE_REST + _STAFF + "SELECT card.*, "
                   + ", ".join(_flag(c) for c in _FLAG_METRICS) + " FROM card")

OWNER_COUNTS = "WITH " + VIEWS.strip() + """
SELECT owner, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT owner_a AS owner FROM plans UNION ALL SELECT owner_b FROM plans) z
WHERE owner IS NOT NULL GROUP BY owner
"""

WORKING_DAYS = f"""
WITH months AS (SELECT DISTINCT CAST(date_trunc('month', {timeline("o_orderdate", "o_custkey")}) AS DATE) AS month_start FROM orders),
days AS (
  SELECT month_start, CAST(unnest(generate_series(CAST(month_start AS TIMESTAMP),
                                                  CAST(last_day(month_start) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
  FROM months),
w AS (SELECT month_start, d, ROW_NUMBER() OVER (PARTITION BY month_start ORDER BY d) AS k
      FROM days WHERE dayofweek(d) <> 0)
SELECT m.month_start, CAST(day(last_day(m.month_start)) AS INTEGER) AS days_in_month,
       CAST((SELECT COUNT(*) FROM w WHERE w.month_start = m.month_start) AS INTEGER) AS working_days,
       m.month_start AS working_day_0,
       COALESCE((SELECT d FROM w WHERE w.month_start = m.month_start AND k = 10),
                (SELECT MAX(d) FROM w WHERE w.month_start = m.month_start)) AS working_day_10,
       COALESCE((SELECT d FROM w WHERE w.month_start = m.month_start AND k = 30),
                (SELECT MAX(d) FROM w WHERE w.month_start = m.month_start)) AS working_day_30
FROM months m
"""

DURATION_MIX = _r(""",
npd AS (SELECT *, CAST(CASE WHEN total_service_months IS NULL OR total_service_months < 1 THEN 1
                            ELSE total_service_months END AS BIGINT) AS duration_months
        FROM c4 WHERE plan_type = 'New Plan'),
buckets AS (SELECT DISTINCT duration_months FROM npd),
brs AS (SELECT * FROM (VALUES ('AFRICA'), ('AMERICA'), ('ASIA'), ('EUROPE'), ('MIDEAST')) v(scope)),
dper AS (SELECT * FROM (VALUES ('yesterday', DATE '1996-12-15', DATE '1996-12-15'),
                              ('mtd', DATE '1996-12-01', DATE '1996-12-15')) v(period, d1, d2)),
cnt AS (
  SELECT n.duration_months, p.period, n.branch AS scope, COUNT(*) AS c, SUM(n.amount) AS a
  FROM npd n JOIN dper p ON n.start_date BETWEEN p.d1 AND p.d2
  WHERE n.branch IN (SELECT scope FROM brs) GROUP BY ALL),
allc AS (SELECT * FROM cnt UNION ALL
         SELECT duration_months, period, 'Total', SUM(c), SUM(a) FROM cnt GROUP BY duration_months, period)
SELECT b.duration_months,
       CASE WHEN b.duration_months = 12 THEN '1 Year' ELSE CAST(b.duration_months AS VARCHAR) || ' Month' END AS duration_label,
       CAST(COALESCE(list_position([1, 2, 3, 6, 9, 12], b.duration_months), 7) AS INTEGER) AS label_rank,
       p.period, s.scope, CAST(COALESCE(a.c, 0) AS BIGINT) AS plan_count,
       CAST(round_even(COALESCE(a.a, 0), 0) AS BIGINT) AS amount
FROM buckets b CROSS JOIN dper p CROSS JOIN (SELECT scope FROM brs UNION ALL SELECT 'Total') s
LEFT JOIN allc a ON a.duration_months = b.duration_months AND a.period = p.period AND a.scope = s.scope
""")

DURATION_TABLE = f"""
SELECT label_rank, duration_months, duration_label,
       {", ".join(f"CAST(SUM(CASE WHEN scope = '{b}' THEN plan_count END) AS BIGINT) AS {b}" for b in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDEAST", "Total"))}
FROM ({DURATION_MIX}) x WHERE period = 'mtd' GROUP BY label_rank, duration_months, duration_label
"""

_SRC = ("CASE WHEN {s} IS NULL OR lower({s}) IN ('', 'none', 'nan') THEN 'Unknown' "
        "WHEN contains(lower({s}), 'practo') AND NOT contains(lower({s}), 'insta') THEN 'Practo' "
        "WHEN contains(lower({s}), 'practo') AND contains(lower({s}), 'insta') THEN 'Practo-Insta' "
        "ELSE {s} END")
_ORDER = ("Practo", "GMB", "1 MG", "Website", "Referral", "Organic", "Google/ IVR Leads",
          "Whatsapp", "Internal Referral", "Client Referral", "TATA AIA", "Primus", "Walk-in",
          "Facebook", "Digital Leads", "Docgenie", "Instagram", "Practo-Insta", "Team Referral")

SOURCE_MIX = _r(""",
sf AS (
  SELECT {v} AS source, CASE WHEN opd_status = 'NEW OPD' THEN 1 ELSE 0 END AS new_visits,
         CASE WHEN opd_status = 'OLD OPD' THEN 1 ELSE 0 END AS old_visits,
         CASE WHEN is_suggest = 'Yes' THEN 1 ELSE 0 END AS suggested, 0 AS new_plans, 0 AS renewals, 0 AS revivals
  FROM c5r WHERE visit_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15'
  UNION ALL
  SELECT {p}, 0, 0, 0, CASE WHEN plan_type = 'New Plan' THEN 1 ELSE 0 END,
         CASE WHEN plan_type = 'Renewal' THEN 1 ELSE 0 END, CASE WHEN plan_type = 'Revival' THEN 1 ELSE 0 END
  FROM c4 WHERE start_date BETWEEN DATE '1996-12-01' AND DATE '1996-12-15'
  UNION ALL
  SELECT l, 0, 0, 0, 0, 0, 0 FROM (VALUES {labels}) v(l)),
g AS (
  SELECT source, FALSE AS is_total, SUM(new_visits) AS nv, SUM(old_visits) AS ov, SUM(suggested) AS sg,
         SUM(new_plans) AS np, SUM(renewals) AS rn, SUM(revivals) AS rv FROM sf GROUP BY source
  UNION ALL
  SELECT 'Total', TRUE, SUM(new_visits), SUM(old_visits), SUM(suggested), SUM(new_plans), SUM(renewals),
         SUM(revivals) FROM sf)
SELECT source, CAST(nv AS BIGINT) AS new_visits, CAST(ov AS BIGINT) AS old_visits, CAST(sg AS BIGINT) AS suggested,
       CAST(np AS BIGINT) AS new_plans, CAST(rn AS BIGINT) AS renewals, CAST(rv AS BIGINT) AS revivals,
       CAST(nv + ov AS BIGINT) AS total_visits,
       CASE WHEN nv = 0 THEN 0.0 ELSE round_even(CAST(np AS DOUBLE) / nv * 100, 1) END AS conversion_pct,
       CAST(CASE WHEN is_total THEN 22 WHEN list_position({arr}, source) IS NOT NULL THEN list_position({arr}, source)
            WHEN source = 'Unknown' THEN 21 ELSE 20 END AS INTEGER) AS label_rank,
       is_total
FROM g
""".format(v=_SRC.format(s=strip("entity_source")), p=_SRC.format(s=strip("entity_source")),
           labels=", ".join("('" + x + "')" for x in _ORDER),
           arr="[" + ", ".join("'" + x + "'" for x in _ORDER) + "]"))

SOURCE_MIX_DISPLAY = f"""
SELECT source, new_visits, old_visits, total_visits, suggested, new_plans, renewals, revivals, conversion_pct,
       row_number() OVER (ORDER BY is_total, total_visits DESC, source) - 1 AS position
FROM ({SOURCE_MIX})
"""

JSON_LIST_JOIN = """
WITH src AS (
  SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN p_brand END AS prim,
         CASE WHEN p_size % 10 = 0 THEN '[]' WHEN p_size % 10 = 1 THEN '[null]' WHEN p_size % 10 = 2 THEN NULL
              ELSE '[" ' || replace(p_name, ' ', '\\n", "\\t') || '\\r"]' END AS arr
  FROM part),
lst AS (
  SELECT p_partkey, prim,
         list_filter(list_transform(CAST(json_extract_string(arr, '$[*]') AS VARCHAR[]),
                                    lambda x: trim(x, ' ' || chr(10) || chr(9) || chr(13))),
                     lambda x: x IS NOT NULL) AS l
  FROM src)
SELECT p_partkey, COALESCE(prim, CASE WHEN len(l) > 0 THEN array_to_string(l, ', ') END) AS primary_diagnosis
FROM lst
"""

NAME_CANONICAL = f"""
WITH alias AS (SELECT DISTINCT replace(s_name, '#', ' #') AS tech_name,
                      CASE WHEN s_nationkey = 0 THEN '' ELSE 'Team ' || CAST(s_nationkey AS VARCHAR) END AS final_name
               FROM supplier WHERE s_nationkey < 3),
raw AS (SELECT s_suppkey AS staff_id,
               CASE WHEN s_suppkey % 11 = 0 THEN '  nan ' WHEN s_suppkey % 13 = 0 THEN ' ' || chr(9) || ' '
                    ELSE {MESSY} END AS staff_raw
        FROM supplier)
SELECT staff_id, {canon('raw.staff_raw', 'a')} AS staff
FROM raw LEFT JOIN alias a ON a.tech_name = {clean('raw.staff_raw')}
"""

SOURCE_NORMALISE = """
SELECT doc_id, source,
       CASE WHEN {s} IS NULL OR lower({s}) IN ('', 'none', 'nan') THEN 'Unknown'
            WHEN contains(lower({s}), 'src1') AND NOT contains(lower({s}), '5') THEN 'S1'
            WHEN contains(lower({s}), 'src1') AND contains(lower({s}), '5') THEN 'S1-5'
            ELSE {s} END AS norm_source
FROM documents
""".format(s=strip("source"))

REJECT_TEST_NAMES = """
SELECT p_partkey, p_name FROM part
WHERE LOWER(p_name) NOT LIKE 'red%' AND LOWER(p_name) NOT LIKE '%red'
"""

TRAILING_YEAR = f"""
SELECT CAST(date_trunc('month', day) AS DATE) AS month_start, strftime(day, '%b-%y') AS opd_month, CAST(COUNT(*) AS BIGINT) AS visits
FROM (SELECT {timeline("l_shipdate", "o_custkey")} AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
WHERE day BETWEEN DATE '1997-06-01' AND DATE '1998-06-16'
GROUP BY ALL
"""

FEED_RECORDS = """
SELECT o_orderpriority AS lead_source, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS created_at,
       CASE o_orderkey % 3 WHEN 0 THEN o_orderstatus || '-plan'
                           WHEN 1 THEN 'T' || CAST(o_orderkey % 5 AS VARCHAR) || ', extra'
                           ELSE 'flat-' || o_orderstatus END AS package,
       CASE WHEN o_orderkey % 2 = 0 THEN 'L' || CAST(o_custkey % 9 AS VARCHAR) || ', 5' ELSE '' END AS assignments,
       CAST(1 + o_orderkey % 12 AS VARCHAR) AS months_with_us
FROM orders
WHERE o_orderkey % 17 <> 0 AND CAST(o_orderdate AS DATE) >= DATE '1997-06-01'
"""

STAFF_DISPLAY = f"""
SELECT staff AS "Therapist", new_visits, row_number() OVER (ORDER BY staff) - 1 AS position FROM ({STAFF_SCORECARD})
"""

REPORT_ORACLE = {
    "source_mix_display": SOURCE_MIX_DISPLAY,
    "staff_display": STAFF_DISPLAY,
    "staff_scorecard": STAFF_SCORECARD,
    "owner_counts": OWNER_COUNTS,
    "extreme_flags": EXTREME_FLAGS,
    "period_metrics": PERIOD_METRICS,
    "period_metrics_refreshed": PERIOD_METRICS,
    "scorecard_change": SCORECARD_CHANGE,
    "working_days": WORKING_DAYS,
    "best_period": BEST_PERIOD,
    "target_vs_achieved": TARGET_VS_ACHIEVED,
    "duration_mix": DURATION_MIX,
    "duration_table": DURATION_TABLE,
    "source_mix": SOURCE_MIX,
    "branch_metric_table": BRANCH_METRIC_TABLE,
    "json_list_join": JSON_LIST_JOIN,
    "name_canonical": NAME_CANONICAL,
    "source_normalise": SOURCE_NORMALISE,
    "reject_test_names": REJECT_TEST_NAMES,
    "trailing_year": TRAILING_YEAR,
    "feed_records": FEED_RECORDS,
}
