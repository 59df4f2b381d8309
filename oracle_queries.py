"""Independent SQL for every registered query, in the dialect of DuckDB.

Money is held in cents and rates in 1/10000 as whole numbers; every rounding is
half up in integers. Nothing here is shared with the Spark code.
"""

from __future__ import annotations


def half_up(num: str, den: str) -> str:
    n, d = f"({num})", f"nullif(({den}), 0)"
    return f"(CASE WHEN {n} >= 0 THEN (2 * {n} + {d}) // (2 * {d}) ELSE -((2 * -{n} + {d}) // (2 * {d})) END)"


def dbl(units: str, scale: int) -> str:
    return f"(CAST({units} AS DOUBLE) / {scale})"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


NULL = "CAST(NULL AS VARCHAR)"

# --- tables of the domain ---------------------------------------------------

DOMAIN = f"""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c, 'P' || o_custkey AS pid, o_orderstatus AS st, o_orderpriority AS pr,
         CAST(year(o_orderdate) AS INTEGER) AS yr, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso,
         CAST(floor(o_totalprice / 100) AS BIGINT) AS charge, CAST(floor(o_totalprice / 125) AS BIGINT) AS allowed,
         c_mktsegment AS seg,
         CASE o_orderkey % 3 WHEN 0 THEN 'professional' WHEN 1 THEN 'institutional' ELSE 'pharmacy' END AS ctype
  FROM orders JOIN customer ON o_custkey = c_custkey
), d AS (
  SELECT *,
    CASE WHEN c % 40 = 0 THEN NULL WHEN k % 10 = 9 THEN 'SECONDARY'
         WHEN seg = 'MACHINERY' THEN 'NO_INSURANCE' ELSE seg END AS payer,
    CASE seg
      WHEN 'AUTOMOBILE' THEN st = 'P' AND pr < '3'
      WHEN 'FURNITURE' THEN (st = 'P' AND pr < '4') OR k % 25 = 1
      WHEN 'BUILDING' THEN st = 'P' AND pr < '5'
      WHEN 'HOUSEHOLD' THEN st = 'P'
      WHEN 'MACHINERY' THEN st = 'P' OR pr < '2'
      ELSE false END AS refused
  FROM o
), x AS (
  SELECT *, CASE WHEN k % 50 = 0 THEN NULL WHEN refused THEN 0 ELSE allowed END AS pay FROM d
), cond AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, 'P' || o_custkey AS pid,
         p_type, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, l_linestatus AS st
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
  WHERE l_returnflag = 'R'
), ev AS (
  SELECT 'V' || event_id AS id, CAST(year(ts) AS INTEGER) AS yr, 'P' || user_id AS pid, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso
  FROM events
)"""

SILVER = {
    "patients": f"""SELECT 'P' || c_custkey AS patient_id, {NULL} AS birth_date, {NULL} AS gender, n_name AS state,
        {NULL} AS city, {NULL} AS postal_code, c_mktsegment AS marital_status
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "claims": f"""SELECT 'C' || k AS claim_id, st AS status, iso AS created, yr AS claim_year, pid AS patient_id,
        {NULL} AS provider_id, {NULL} AS payer_id, CAST(charge AS DOUBLE) AS total_submitted_charge,
        ctype AS claim_type, pr AS primary_diagnosis_code, {NULL} AS primary_diagnosis_desc FROM o""",
    "explanations": f"""SELECT 'E' || k AS eob_id, {NULL} AS status, {NULL} AS outcome, iso AS created,
        yr AS eob_year, pid AS patient_id, 'C' || k AS claim_id, CAST(pay AS DOUBLE) AS payment_amount,
        {NULL} AS prior_auth_ref, {NULL} AS coverage_ref FROM x""",
    "coverages": f"""SELECT 'E' || k || '_coverage' AS coverage_id, {NULL} AS status, pid AS patient_id,
        payer AS payer_name, iso AS coverage_start, {NULL} AS coverage_end, seg AS coverage_type FROM x""",
    "prior_auth": f"""SELECT 'E' || k || '_referral' AS service_request_id, st AS status, {NULL} AS intent,
        pid AS patient_id, pr AS procedure_code, {NULL} AS procedure_description, iso AS authored_on,
        yr AS auth_year, {NULL} AS reason_code, {NULL} AS reason_description, {NULL} AS requester_ref FROM o""",
    "encounters": f"""SELECT id AS encounter_id, {NULL} AS status, yr AS encounter_year, pid AS patient_id,
        event_type AS encounter_class, {NULL} AS encounter_type, iso AS encounter_start,
        {NULL} AS encounter_end, {NULL} AS provider_name FROM ev""",
    "conditions": f"""SELECT id AS condition_id, pid AS patient_id, p_type AS icd10_code,
        {NULL} AS condition_description, iso AS onset_date, {NULL} AS abatement_date,
        st AS clinical_status FROM cond""",
}

# --- profiles, gold, staging, marts in whole units (_c cents, _p 1/10000) ----

PROFILES = (
    DOMAIN
    + f""", eob AS (
  SELECT pid, count(*) AS n, count(*) FILTER (WHERE pay > 0) AS ok,
         {half_up("sum(pay) * 100", "count(*)")} AS pay_c,
         {half_up("count(*) FILTER (WHERE pay > 0) * 10000", "count(*)")} AS rate_p
  FROM x WHERE pay IS NOT NULL GROUP BY pid
), cl_first AS (
  SELECT pid, ctype FROM (
    SELECT pid, ctype, row_number() OVER (PARTITION BY pid ORDER BY iso, 'C' || k) AS r FROM x) WHERE r = 1
), cl AS (
  SELECT pid, any_value(cl_first.ctype) AS ctype, {half_up("sum(charge) * 100", "count(*)")} AS charge_c
  FROM x JOIN cl_first USING (pid) GROUP BY pid
), cov AS (
  SELECT pid, payer, seg FROM (
    SELECT pid, payer, seg,
           row_number() OVER (PARTITION BY pid ORDER BY iso DESC, 'E' || k || '_coverage' DESC) AS r FROM x) WHERE r = 1
), prof AS (
  SELECT cl.pid, cl.ctype, charge_c, n, ok, rate_p, pay_c, payer, seg
  FROM cl JOIN eob ON cl.pid = eob.pid LEFT JOIN cov ON cl.pid = cov.pid
), ins AS (SELECT * FROM prof WHERE payer IS NOT NULL)"""
)

GOLD = (
    PROFILES
    + f""", rates AS (
  SELECT ctype, payer, count(*) AS patients, sum(n) AS claims, sum(ok) AS approved,
         {half_up("sum(rate_p)", "count(*)")} AS approval_p,
         {half_up("10000 * count(*) - sum(rate_p)", "count(*)")} AS denial_p,
         {half_up("sum(pay_c)", "count(*)")} AS pay_c, {half_up("sum(charge_c)", "count(*)")} AS charge_c
  FROM ins GROUP BY ctype, payer
), perf AS (
  SELECT payer, count(*) AS patients, sum(n) AS claims, sum(ok) AS approved,
         {half_up("sum(rate_p)", "count(*)")} AS approval_p,
         {half_up("10000 * count(*) - sum(rate_p)", "count(*)")} AS denial_p,
         {half_up("sum(pay_c)", "count(*)")} AS pay_c, {half_up("sum(charge_c)", "count(*)")} AS charge_c,
         {half_up("sum(charge_c) * (10000 * count(*) - sum(rate_p))", "10000 * count(*)")} AS risk_c
  FROM ins GROUP BY payer
), pa AS (
  SELECT 'E' || k || '_referral' AS id, o.pid, o.st, o.iso, ins.payer, ins.seg, ins.ctype, rate_p,
         10000 - rate_p AS denial_p, charge_c, coalesce(10000 - rate_p, 5000) AS score_p,
         CASE WHEN coalesce(10000 - rate_p, 5000) >= 7000 THEN 'HIGH'
              WHEN coalesce(10000 - rate_p, 5000) >= 4000 THEN 'MEDIUM' ELSE 'LOW' END AS tier,
         {half_up("coalesce(charge_c, 0) * coalesce(10000 - rate_p, 5000)", "10000")} AS risk_c
  FROM o LEFT JOIN ins ON o.pid = ins.pid
)"""
)

MARTS = (
    GOLD
    + f""", srates AS (
  SELECT *, CASE WHEN pay_c > 0 THEN {half_up("charge_c * 10000", "pay_c")} END AS ratio_p FROM rates
), pa_payer AS (
  SELECT payer, count(id) AS requests, count(*) FILTER (WHERE tier = 'HIGH') AS high,
         count(*) FILTER (WHERE tier = 'MEDIUM') AS medium, count(*) FILTER (WHERE tier = 'LOW') AS low,
         {half_up("sum(score_p)", "count(*)")} AS score_p, sum(risk_c) AS pa_risk_c
  FROM pa GROUP BY payer
), score AS (
  SELECT p.*, coalesce(requests, 0) AS requests, coalesce(high, 0) AS high, coalesce(medium, 0) AS medium,
         coalesce(low, 0) AS low, score_p, pa_risk_c,
         CASE WHEN denial_p > 3500 THEN 'NON_COMPLIANT_HIGH_DENIAL' WHEN denial_p > 2500 THEN 'WATCH_LIST'
              ELSE 'COMPLIANT' END AS compliance
  FROM perf p LEFT JOIN pa_payer q ON p.payer = q.payer
), rev AS (
  SELECT *, claims - approved AS denied, (claims - approved) * charge_c AS risk_c,
         CASE WHEN approval_p < 8000
              THEN {half_up("(8000 - approval_p) * claims * pay_c", "10000")} ELSE 0 END AS recover_c,
         CASE WHEN denial_p >= 3500 THEN 'CRITICAL' WHEN denial_p >= 2500 THEN 'HIGH'
              WHEN denial_p >= 2000 THEN 'MEDIUM' ELSE 'LOW' END AS level
  FROM srates
), summ AS (
  SELECT payer, sum(claims) AS claims, sum(approved) AS approved,
         {half_up("sum(approved) * 10000", "sum(claims)")} AS rate_p, {half_up("sum(pay_c)", "count(pay_c)")} AS pay_c,
         {half_up("sum(charge_c)", "count(charge_c)")} AS charge_c,
         {half_up("sum(ratio_p)", "count(ratio_p)")} AS ratio_p, count(DISTINCT ctype) AS types
  FROM srates GROUP BY payer
), bench AS (
  SELECT *, {half_up("rate_p * (count(rate_p) OVER ()) - (sum(rate_p) OVER ())", "count(rate_p) OVER ()")} AS vs_p,
         {half_up("charge_c * (count(charge_c) OVER ()) - (sum(charge_c) OVER ())", "count(charge_c) OVER ()")} AS vs_c,
         rank() OVER (ORDER BY rate_p DESC NULLS FIRST) AS rnk, count(*) OVER () AS payers
  FROM summ
), top AS (
  SELECT * FROM pa WHERE tier IN ('HIGH', 'MEDIUM') ORDER BY score_p DESC, id LIMIT 5000
), vrev AS (
  SELECT payer AS payer_name, ctype AS claim_type, {big("claims")} AS total_claims,
         {dbl("charge_c", 100)} AS avg_submitted_charge, {dbl("approval_p", 100)} AS approval_pct,
         {dbl("denial_p", 100)} AS denial_pct, {dbl("risk_c", 100)} AS revenue_at_risk,
         level AS financial_risk_level, risk_c, denial_p FROM rev
), vbench AS (
  SELECT {big("rnk")} AS approval_rank, b.payer AS payer_name, {dbl("b.rate_p", 100)} AS approval_pct,
         {dbl("10000 - b.rate_p", 100)} AS denial_pct, {dbl("vs_p", 10000)} AS vs_market_approval_rate,
         {big("b.claims")} AS total_claims, {dbl("perf.risk_c", 100)} AS total_revenue_at_risk, b.rate_p
  FROM bench b LEFT JOIN perf ON b.payer = perf.payer
)"""
)

EOB_OUT = f"""pid AS patient_id, n AS total_claims, ok AS approved_claims, {dbl("rate_p", 10000)} AS approval_rate,
    {dbl("pay_c", 100)} AS avg_payment"""


def rate_columns(prefix: str) -> str:
    return f"""{big("claims")} AS total_claims, {big("approved")} AS total_approved,
    {dbl("approval_p", 10000)} AS {prefix}approval_rate, {dbl("denial_p", 10000)} AS {prefix}denial_rate,
    {dbl("pay_c", 100)} AS avg_payment_amount, {dbl("charge_c", 100)} AS avg_submitted_charge"""


RATES_OUT = f"ctype AS ar_claim_type, payer AS ar_payer_name, patients AS total_patients, {rate_columns('')}"
PERF_OUT = f"""payer AS payer_name, patients AS unique_patients, {rate_columns('avg_')},
    {dbl("risk_c", 100)} AS total_revenue_at_risk"""
TIER = """CASE WHEN approval_p >= 8000 THEN 'TIER_1_BEST' WHEN approval_p >= 7500 THEN 'TIER_2_GOOD'
    WHEN approval_p >= 7000 THEN 'TIER_3_AVERAGE' ELSE 'TIER_4_POOR' END AS payer_tier"""
PA_OUT = f"""id AS service_request_id, pid AS patient_id, st AS status, iso AS authored_on, payer AS payer_name,
    seg AS coverage_type, ctype AS claim_type, {dbl("rate_p", 10000)} AS historical_approval_rate,
    {dbl("denial_p", 10000)} AS historical_denial_rate, {dbl("charge_c", 100)} AS avg_submitted_charge,
    {dbl("score_p", 10000)} AS pa_risk_score, tier AS risk_tier, {dbl("risk_c", 100)} AS revenue_at_risk"""
UNINSURED = "coalesce(payer = 'NO_INSURANCE', false) AS is_uninsured"
RISK_OUT = f"""{dbl(half_up("sum(score_p)", "count(*)"), 10000)} AS avg_risk_score,
    {dbl("sum(risk_c)", 100)} AS total_revenue_at_risk"""
SCORE_OUT = f"""{PERF_OUT}, {TIER}, requests AS total_pa_requests, high AS high_risk_pa_count,
    medium AS medium_risk_pa_count, low AS low_risk_pa_count, {dbl("score_p", 10000)} AS avg_pa_risk_score,
    {dbl("pa_risk_c", 100)} AS total_pa_revenue_at_risk, compliance AS cms_compliance_status"""
REV_OUT = f"""{RATES_OUT}, {big("denied")} AS total_denied, {dbl("ratio_p", 10000)} AS charge_to_payment_ratio,
    {dbl("risk_c", 100)} AS revenue_at_risk, {dbl("recover_c", 100)} AS recovery_potential_at_80pct,
    level AS financial_risk_level"""
SUMMARY_OUT = f"""payer AS payer_name, {big("claims")} AS total_claims, {big("approved")} AS total_approved,
    {dbl("rate_p", 10000)} AS overall_approval_rate, {dbl("pay_c", 100)} AS avg_payment,
    {dbl("charge_c", 100)} AS avg_charge, {dbl("ratio_p", 10000)} AS avg_charge_ratio, types AS claim_types_covered"""
EXPLORER_OUT = f"""id AS service_request_id, pid AS patient_id, payer AS payer_name, ctype AS claim_type,
    seg AS coverage_type, {dbl("score_p", 10000)} AS pa_risk_score, tier AS risk_tier,
    {dbl("rate_p", 10000)} AS historical_approval_rate, {dbl("denial_p", 10000)} AS historical_denial_rate,
    {dbl("charge_c", 100)} AS avg_submitted_charge, {dbl("risk_c", 100)} AS revenue_at_risk"""


def millions(cents: str) -> str:
    return f"({dbl(cents, 100)} / 1000000)"


# --- bundles ----------------------------------------------------------------

TOP_LEVEL = """SELECT 'Patient' AS resource_type, 'P' || c_custkey AS resource_id FROM customer
  UNION ALL SELECT 'Claim', 'C' || k FROM o
  UNION ALL SELECT 'ExplanationOfBenefit', 'E' || k FROM o
  UNION ALL SELECT 'Encounter', id FROM ev
  UNION ALL SELECT 'Condition', id FROM cond"""
CONTAINED = """SELECT 'Coverage' AS resource_type, 'E' || k || '_coverage' AS resource_id FROM o
  UNION ALL SELECT 'ServiceRequest', 'E' || k || '_referral' FROM o"""
# The same with the file of each resource.
FILED_TOP_LEVEL = """SELECT 'P' || c_custkey AS file_path, 'Patient' AS resource_type, 'P' || c_custkey AS resource_id FROM customer
  UNION ALL SELECT 'O' || k, 'Claim', 'C' || k FROM o
  UNION ALL SELECT 'O' || k, 'ExplanationOfBenefit', 'E' || k FROM o
  UNION ALL SELECT id, 'Encounter', id FROM ev
  UNION ALL SELECT id, 'Condition', id FROM cond"""
FILED_CONTAINED = """SELECT 'O' || k AS file_path, 'Coverage' AS resource_type, 'E' || k || '_coverage' AS resource_id FROM o
  UNION ALL SELECT 'O' || k, 'ServiceRequest', 'E' || k || '_referral' FROM o"""

# --- quality ----------------------------------------------------------------

# The minimum rows of the checked tables.
CHECKED = {
    "patients": ("customer", 4000),
    "claims": ("o", 400000),
    "explanations": ("x", 400000),
    "coverages": ("x", 400000),
    "encounters": ("ev", 200000),
    "conditions": ("cond", 150000),
    "prior_auth": ("o", 400000),
    "pa_risk_scores": ("pa", 400000),
    "procedure_approval_rates": ("rates", 10),
    "payer_performance": ("perf", 5),
    "mart_pa_compliance_scorecard": ("score", 5),
    "mart_revenue_at_risk": ("rev", 10),
    "mart_payer_benchmarks": ("bench", 5),
    "mart_high_risk_pa_requests": ("(SELECT 1 FROM pa WHERE tier IN ('HIGH', 'MEDIUM'))", 1),
}


VIEWS = {"vw_pa_compliance_scorecard": "score", "vw_revenue_at_risk": "rev", "vw_payer_benchmarks": "bench"}
GOLD_TABLES = [name for name in CHECKED if name.startswith("mart_")] + [
    "procedure_approval_rates",
    "payer_performance",
    "pa_risk_scores",
]


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in tables.items()
    )


REPORT = (
    MARTS
    + ", report AS (SELECT *, CASE WHEN row_count >= minimum_rows THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, CAST({minimum} AS BIGINT) AS minimum_rows FROM {source}"
        for name, (source, minimum) in CHECKED.items()
    )
    + "))"
)

STEPS = {
    "eob_by_patient": "eob",
    "claims_by_patient": "cl",
    "coverages": "x",
    "coverage_current": "cov",
    "prior_auth": "o",
    "patient_profile": "prof",
    "patient_profile_with_payer": "ins",
    "procedure_approval_rates": "rates",
    "payer_performance": "perf",
    "pa_risk_scores": "pa",
}


def oracles() -> dict[str, str]:
    sql = {f"silver_{name}": f"{DOMAIN} {select}" for name, select in SILVER.items()}
    sql |= {
        # profiles and gold
        "eob_by_patient": f"{PROFILES} SELECT {EOB_OUT} FROM eob",
        "claims_by_patient": f"""{PROFILES} SELECT pid AS patient_id, ctype AS primary_claim_type,
            {dbl("charge_c", 100)} AS avg_charge FROM cl""",
        "coverage_current": f"{PROFILES} SELECT pid AS patient_id, payer AS payer_name, seg AS coverage_type FROM cov",
        "patient_profile": f"""{PROFILES} SELECT {EOB_OUT}, ctype AS primary_claim_type,
            {dbl("charge_c", 100)} AS avg_charge, payer AS payer_name, seg AS coverage_type FROM prof""",
        "procedure_approval_rates": f"{GOLD} SELECT {RATES_OUT} FROM rates",
        "payer_performance": f"{GOLD} SELECT {PERF_OUT} FROM perf",
        "pa_risk_scores": f"{GOLD} SELECT {PA_OUT} FROM pa",
        "report_risk_tiers": f"{GOLD} SELECT tier AS risk_tier, count(*) AS count, {RISK_OUT} FROM pa GROUP BY tier",
        "report_risk_by_payer": f"""{GOLD} SELECT payer AS payer_name, count(*) AS pa_requests, {RISK_OUT} FROM pa
            WHERE payer IS NOT NULL GROUP BY payer ORDER BY sum(risk_c) DESC, payer LIMIT 20""",
        # staging and marts
        "stg_approval_rates": f"""{MARTS} SELECT {RATES_OUT}, {dbl("ratio_p", 10000)} AS charge_to_payment_ratio
            FROM srates""",
        "stg_payer_performance": f"{MARTS} SELECT {PERF_OUT}, {TIER} FROM perf",
        "stg_pa_risk_scores": f"{MARTS} SELECT {PA_OUT}, {UNINSURED} FROM pa",
        "payer_summary": f"{MARTS} SELECT {SUMMARY_OUT} FROM summ",
        "mart_pa_compliance_scorecard": f"{MARTS} SELECT {SCORE_OUT} FROM score",
        "mart_revenue_at_risk": f"{MARTS} SELECT {REV_OUT} FROM rev",
        "mart_payer_benchmarks": f"""{MARTS} SELECT {SUMMARY_OUT}, {dbl("vs_p", 10000)} AS vs_market_approval_rate,
            {dbl("vs_c", 100)} AS vs_market_avg_charge, {big("rnk")} AS approval_rate_rank,
            payers AS total_payers FROM bench""",
        "mart_high_risk_pa_requests": f"""{MARTS} SELECT {PA_OUT}, {UNINSURED},
            {dbl(half_up("score_p * coalesce(charge_c, 0)", "100000"), 10000)} AS priority_score,
            CASE WHEN score_p >= 7000 AND charge_c > 200000 THEN 'IMMEDIATE_APPEAL_RECOMMENDED'
                 WHEN score_p >= 7000 THEN 'APPEAL_RECOMMENDED' WHEN score_p >= 4000 THEN 'MONITOR'
                 ELSE 'NO_ACTION' END AS recommended_action
            FROM pa WHERE tier IN ('HIGH', 'MEDIUM')""",
        # bundles
        "bundle_scan": f"""{DOMAIN} SELECT resource_type, count(*) AS resources, true AS bounded, true AS mixed
            FROM ({TOP_LEVEL}) GROUP BY resource_type""",
        "bundle_inventory": f"""{DOMAIN} SELECT true AS arrived, CAST(4 AS BIGINT) AS empty_files, true AS all_scanned,
            true AS all_bytes, count(*) AS resources FROM ({TOP_LEVEL})""",
        "bundle_entries": f"{DOMAIN} {FILED_TOP_LEVEL}",
        "bundle_contained": f"{DOMAIN} {FILED_CONTAINED}",
        "bundle_quarantine": """SELECT 'P' || c_custkey AS document FROM customer WHERE c_custkey % 25 = 0
            UNION ALL SELECT unnest(['empty-patient', 'empty-order', 'empty-encounter', 'empty-condition'])""",
        "resource_type_distribution": f"""{DOMAIN} SELECT resource_type, count(*) AS count
            FROM ({TOP_LEVEL} UNION ALL {CONTAINED}) GROUP BY resource_type ORDER BY count DESC, resource_type LIMIT 30""",
        # functions
        "fn_json_path": f"""SELECT event_id, json_extract_string(props, '$.k') AS k, {NULL} AS missing,
            json_extract_string(props, '$.k') AS first_item, {NULL} AS past_end FROM events""",
        "fn_reference_extract": f"""SELECT o_orderkey,
            CASE o_orderkey % 4 WHEN 0 THEN 'P' || o_custkey WHEN 1 THEN 'P' || o_custkey WHEN 2 THEN '' END AS patient_id,
            CASE o_orderkey % 3 WHEN 0 THEN 'D' || o_custkey WHEN 1 THEN '' END AS provider_id,
            CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'G' || o_custkey END AS payer_id,
            CASE o_orderkey % 2 WHEN 0 THEN 'C' || o_orderkey ELSE '' END AS claim_id FROM orders""",
        "fn_event_year": """SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 0 THEN year(o_orderdate)
            WHEN 1 THEN year(o_orderdate) WHEN 2 THEN year(o_orderdate) WHEN 3 THEN year(o_orderdate) + 1
            END AS INTEGER) AS event_year FROM orders""",
        "fn_safe_cast": """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN floor(o_totalprice) + 0.25
            WHEN 1 THEN floor(o_totalprice) END AS amount FROM orders""",
        # serving
        "view_pa_compliance_scorecard": f"{MARTS} SELECT {SCORE_OUT} FROM score",
        "view_revenue_at_risk": f"{MARTS} SELECT * EXCLUDE (risk_c, denial_p) FROM vrev",
        "view_payer_benchmarks": f"{MARTS} SELECT * EXCLUDE (rate_p) FROM vbench",
        "dash_scorecard_kpis": f"""{MARTS} SELECT {big("sum(requests)")} AS total_pa_requests,
            {big("sum(high)")} AS high_risk_pas, {millions("sum(pa_risk_c)")} AS revenue_at_risk_millions,
            count(*) FILTER (WHERE compliance = 'NON_COMPLIANT_HIGH_DENIAL') AS non_compliant_payers FROM score""",
        "dash_scorecard_bars": f"""{MARTS} SELECT payer AS payer_name, {dbl("pa_risk_c", 100)} AS total_pa_revenue_at_risk,
            compliance AS cms_compliance_status FROM score""",
        "dash_scorecard_detail": f"""{MARTS} SELECT payer AS payer_name, compliance AS cms_compliance_status,
            requests AS total_pa_requests, high AS high_risk_pa_count, {dbl("score_p", 10000)} AS avg_pa_risk_score,
            {dbl("pa_risk_c", 100)} AS total_pa_revenue_at_risk, {dbl("denial_p", 10000)} AS avg_denial_rate FROM score""",
        "dash_tier_distribution": f"""{MARTS} SELECT 'HIGH' AS risk_tier, {big("sum(high)")} AS count FROM score
            UNION ALL SELECT 'MEDIUM', {big("sum(medium)")} FROM score
            UNION ALL SELECT 'LOW', {big("sum(low)")} FROM score""",
        "dash_revenue_kpis": f"""{MARTS} SELECT {millions("sum(risk_c)")} AS revenue_at_risk_millions,
            count(*) FILTER (WHERE level = 'CRITICAL') AS critical_combinations,
            {dbl(half_up("sum(denial_p) * 100", "count(*)"), 10000)} AS avg_denial_pct FROM rev""",
        "dash_revenue_treemap": f"""{MARTS} SELECT CASE WHEN grouping(payer_name) = 1 THEN 'total'
              WHEN grouping(claim_type) = 1 THEN 'payer' ELSE 'claim_type' END AS node, payer_name, claim_type,
            {dbl("sum(risk_c)", 100)} AS revenue_at_risk,
            {dbl(half_up("sum(denial_p * risk_c) * 100", "sum(risk_c)"), 10000)} AS denial_pct
            FROM vrev GROUP BY ROLLUP (payer_name, claim_type)""",
        "dash_revenue_scatter": f"""{MARTS} SELECT payer_name, claim_type, denial_pct, revenue_at_risk,
            financial_risk_level, total_claims FROM vrev""",
        "dash_market_flag": f"""{MARTS} SELECT payer_name, approval_pct,
            {dbl(half_up("(sum(rate_p) OVER ()) * 100", "count(rate_p) OVER ()"), 10000)} AS market_avg_pct,
            rate_p * (count(rate_p) OVER ()) >= sum(rate_p) OVER () AS at_or_above_market FROM vbench""",
        "dash_revenue_by_payer": f"{MARTS} SELECT payer_name, total_revenue_at_risk, approval_pct FROM vbench",
        "dash_payer_ranking": f"{MARTS} SELECT * EXCLUDE (rate_p) FROM vbench",
        "explorer_top_requests": f"{MARTS} SELECT {EXPLORER_OUT} FROM top",
        "explorer_options": f"""{MARTS} SELECT DISTINCT 'payer' AS filter, payer AS choice FROM top
            UNION ALL SELECT DISTINCT 'claim_type', ctype FROM top WHERE ctype IS NOT NULL""",
        "explorer_filter": f"{MARTS} SELECT {EXPLORER_OUT} FROM top WHERE tier = 'HIGH'",
        "explorer_filter_unknown_payer": f"""{MARTS} SELECT {EXPLORER_OUT} FROM top
            WHERE payer IS NULL OR payer = 'SECONDARY'""",
        "explorer_filter_all_rows": f"""{MARTS} SELECT {EXPLORER_OUT} FROM pa WHERE tier = 'MEDIUM'
            AND payer IN ('NO_INSURANCE', 'SECONDARY') AND ctype IN ('professional', 'pharmacy')""",
        "explorer_kpis": f"""{MARTS} SELECT count(*) AS requests_shown,
            {dbl(half_up("sum(score_p)", "count(*)"), 10000)} AS avg_risk_score,
            {millions("sum(risk_c)")} AS revenue_at_risk_millions FROM top WHERE tier = 'HIGH'""",
        "explorer_score_histogram": f"""{MARTS} SELECT tier AS risk_tier,
            CAST(least(score_p // 500, 19) AS DOUBLE) / 20 AS bin_start, count(*) AS requests
            FROM top GROUP BY ALL""",
        "explorer_detail": f"""{MARTS} SELECT id AS service_request_id, payer AS payer_name, ctype AS claim_type,
            tier AS risk_tier, {dbl("score_p", 10000)} AS pa_risk_score, {dbl("denial_p", 10000)} AS historical_denial_rate,
            {dbl("charge_c", 100)} AS avg_submitted_charge, {dbl("risk_c", 100)} AS revenue_at_risk
            FROM top WHERE tier = 'HIGH'""",
        # quality, sinks, catalog
        "quality_report": f"{REPORT} SELECT * FROM report",
        "quality_failures": f"""{REPORT} SELECT table_name,
            table_name || ': ' || row_count || ' < ' || minimum_rows AS message FROM report WHERE status = 'FAIL'""",
        "step_counts": f"{GOLD} {counts(STEPS)}",
        **{f"roundtrip_{t}": f"{DOMAIN} {select}" for t, select in SILVER.items() if t != "claims"},
        "roundtrip_claims_year": f"{DOMAIN} {SILVER['claims']}",
        "mart_high_risk_order": f"""{MARTS} SELECT row_number() OVER (ORDER BY priority DESC, id) AS position,
            id AS service_request_id, {dbl("priority", 10000)} AS priority_score
            FROM (SELECT *, {half_up("score_p * coalesce(charge_c, 0)", "100000")} AS priority FROM pa
                  WHERE tier IN ('HIGH', 'MEDIUM'))""",
        "catalog_tables": f"""{MARTS} SELECT table_name,
            CASE table_name WHEN 'claims' THEN 'claim_year' WHEN 'explanations' THEN 'eob_year'
                 WHEN 'prior_auth' THEN 'auth_year' WHEN 'encounters' THEN 'encounter_year' END AS partition_column,
            row_count FROM ({counts({name: source for name, (source, _) in CHECKED.items()} | VIEWS)})""",
    }
    for table in GOLD_TABLES:
        sql[f"roundtrip_{table}"] = sql[table]
    return sql
