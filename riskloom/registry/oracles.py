"""DuckDB SQL for the registered queries, written independently of the Spark code."""

from __future__ import annotations

from riskloom.functions import fixed_values as fv
from riskloom.functions.draws import Draw
from riskloom.sources import synthetic

DIMENSIONS = """
dim_region AS (
  SELECT n_nationkey AS region_code, n_name AS region_name, r_name AS island_group
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_product AS (
  SELECT DISTINCT p_type AS product_code, p_type AS product_name,
    CASE WHEN p_type IN ('LARGE','MEDIUM','STANDARD') THEN 'Secured' ELSE 'Unsecured' END AS product_class
  FROM part),
dim_lender AS (
  SELECT s_suppkey AS lender_code, s_name AS lender_name,
    CASE s_suppkey % 3 WHEN 0 THEN 'Bank' WHEN 1 THEN 'Fintech' ELSE 'Multifinance' END AS lender_type
  FROM supplier)"""

APPLICATIONS = """
order_lines AS (
  SELECT l_orderkey, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey, max(l_quantity) AS qty,
    count(*) AS n_lines, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey),
apps AS (
  SELECT 'APP' || lpad(o_orderkey::VARCHAR, 8, '0') AS application_id, o_custkey AS subject_id,
    o_orderdate::DATE AS app_date, c_nationkey AS region_code, p_type AS product_code,
    suppkey AS lender_code, o_orderpriority AS channel,
    round(o_totalprice)::DECIMAL(18,0) AS requested_amount, qty::DECIMAL(5,0) AS tenor_months,
    CASE o_orderstatus WHEN 'F' THEN 'APPROVE' WHEN 'P' THEN 'REVIEW' ELSE 'REJECT' END AS decision
  FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN order_lines ON l_orderkey = o_orderkey
  LEFT JOIN part ON p_partkey = partkey)"""

SUBJECTS = """
per_customer AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS largest, sum(n_lines) AS n_lines,
    sum(n_ret) AS n_ret
  FROM orders LEFT JOIN order_lines ON l_orderkey = o_orderkey GROUP BY o_custkey),
per_user AS (SELECT user_id, count(*) AS n_ev FROM events GROUP BY user_id),
core AS (
  SELECT c_custkey AS subject_id, (21 + c_custkey % 44)::INT AS age,
    CASE WHEN c_custkey % 9 < 5 THEN 'M' ELSE 'F' END AS gender, c_mktsegment AS employment_type,
    CASE c_custkey % 5 WHEN 0 THEN 'SMA' WHEN 1 THEN 'D3' WHEN 2 THEN 'S1' WHEN 3 THEN 'S2' ELSE 'SD' END AS education,
    c_nationkey AS region_code, greatest(round(c_acctbal * 6000, 0), 0e0) AS monthly_income,
    round(largest * 20, 0) AS monthly_installment,
    CASE WHEN n_orders IS NULL THEN 1.2e0 ELSE round(least(1.2e0, n_orders * 0.055e0), 3) END AS credit_utilization,
    least(180, 3 * coalesce(n_ret, 0))::INT AS max_dpd_12m,
    least(120, coalesce(n_lines, 0))::INT AS max_dpd_24m,
    CASE WHEN n_ev IS NULL THEN c_custkey % 18 ELSE least(17, n_ev) END::INT AS num_inquiries_12m,
    (c_custkey % 4)::INT AS num_fintech_loans, (c_custkey % 3)::INT AS num_bnpl_accounts,
    (c_custkey % 8)::INT AS num_active_loans, (1 + c_custkey % 5)::INT AS kol_status,
    (coalesce(n_ret, 0) % 10)::INT AS num_late_pmt_12m, (3 + c_custkey % 117)::INT AS avg_acct_age_months
  FROM customer LEFT JOIN per_customer ON o_custkey = c_custkey LEFT JOIN per_user ON user_id = c_custkey),
risk AS (
  SELECT *, 1e0 / (1e0 + exp(-(-2.5e0
    + 0.55e0*((max_dpd_12m-45)/40e0) + 0.30e0*((max_dpd_24m-30)/30e0) + 0.75e0*(credit_utilization-0.5e0)
    + 0.45e0*((num_inquiries_12m-9)/5e0) + 0.30e0*(num_fintech_loans-2) + 0.25e0*(num_bnpl_accounts-2)
    + 0.38e0*(kol_status-3) + 0.18e0*(num_late_pmt_12m-5)
    + 0.80e0*(coalesce(CASE WHEN monthly_installment / nullif(monthly_income, 0) < 3e0
                THEN monthly_installment / nullif(monthly_income, 0) END, 3e0) - 0.5e0)
    - 0.015e0*(age-43) - 0.25e0*((monthly_income-31500000)/20000000e0)
    - 0.30e0*((avg_acct_age_months-60)/40e0)))) AS p
  FROM core),
subjects AS (
  SELECT * EXCLUDE (p), round(p, 6) AS pd_true_prob,
    CASE WHEN ('0x' || substr(md5(subject_id::VARCHAR || ':default'), 1, 8))::BIGINT / 4294967296e0 < p
      THEN 1 ELSE 0 END AS default_flag
  FROM risk),
scores AS (
  SELECT subject_id, pd_true_prob AS pd_probability, 300 + round(550 * (1 - pd_true_prob)) AS credit_score,
    CASE WHEN pd_true_prob < 0.10 THEN 'APPROVE' WHEN pd_true_prob < 0.30 THEN 'REVIEW' ELSE 'REJECT' END AS decision,
    TIMESTAMP '2024-01-31 00:00:00' AS scored_at, 'V2_SPARK_ML' AS model_version
  FROM subjects WHERE monthly_income > 0),
predictions AS (
  SELECT event_id, ts AS scored_at, user_id AS subject_id, value, pd_true_prob, default_flag
  FROM events LEFT JOIN subjects ON subject_id = user_id)"""

MART = """
mart AS (
  SELECT a.application_id, a.subject_id, a.app_date,
    date_trunc('month', a.app_date)::DATE AS app_month, date_trunc('week', a.app_date)::DATE AS app_week,
    year(a.app_date)::BIGINT AS app_year, a.channel, a.requested_amount::DOUBLE AS requested_amount,
    a.tenor_months::DOUBLE AS tenor_months, a.decision,
    CASE WHEN a.decision = 'APPROVE' THEN 1 ELSE 0 END::BIGINT AS is_approved,
    r.region_code::BIGINT AS region_code, r.region_name, r.island_group,
    p.product_code, p.product_name, p.product_class, l.lender_code, l.lender_name, l.lender_type,
    s.pd_probability, s.credit_score,
    CASE WHEN s.credit_score < 580 THEN '1_Poor' WHEN s.credit_score < 670 THEN '2_Fair'
         WHEN s.credit_score < 740 THEN '3_Good' WHEN s.credit_score < 800 THEN '4_VeryGood'
         ELSE '5_Excellent' END AS score_band,
    CASE WHEN s.pd_probability < 0.10 THEN 'Low' WHEN s.pd_probability < 0.30 THEN 'Medium' ELSE 'High' END AS risk_segment,
    f.default_flag::BIGINT AS default_flag, f.monthly_income, f.age::BIGINT AS age, f.credit_utilization
  FROM apps a
  LEFT JOIN dim_region r ON r.region_code = a.region_code
  LEFT JOIN dim_product p ON p.product_code = a.product_code
  LEFT JOIN dim_lender l ON l.lender_code = a.lender_code
  LEFT JOIN scores s ON s.subject_id = a.subject_id
  LEFT JOIN subjects f ON f.subject_id = a.subject_id)"""


def _uniform(name: str, key: str) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR || ':{name}'), 1, 8))::BIGINT / 4294967296e0)"


def draw_sql(draw: Draw, name: str, key: str = "c_custkey") -> str:
    """The value of a draw in DuckDB SQL."""
    u = _uniform(name, key)
    if draw.kind == "choice":
        if not draw.weights:
            options = ", ".join(f"'{o}'" if isinstance(o, str) else str(o) for o in draw.options)
            return f"([{options}])[floor({u} * {len(draw.options)})::INT + 1]"
        total, reached, whens = sum(draw.weights), 0, []
        for option, weight in zip(draw.options[:-1], draw.weights):
            reached += weight
            whens.append(f"WHEN {u} < {reached / total!r}::DOUBLE THEN '{option}'")
        return f"CASE {' '.join(whens)} ELSE '{draw.options[-1]}' END"
    value = f"({float(draw.low)!r}::DOUBLE + {u} * {float(draw.high - draw.low)!r}::DOUBLE)"
    if draw.kind.startswith("product"):
        value = f"({_uniform(name + '/2', key)} * {value})"
    if draw.kind.endswith("integer"):
        return f"floor({value})::BIGINT"
    if draw.cap is not None:
        value = f"least({float(draw.cap)!r}::DOUBLE, {value})"
    return f"(round({value}, {draw.digits}) + 0e0)"


WIDE_DRAWS = synthetic.CORE_DRAWS | synthetic.bureau_draws()


def wide_cte() -> str:
    """The wide subject table; only the columns a query names are computed."""
    drawn = ",\n    ".join(f"{draw_sql(d, n)} AS {n}" for n, d in WIDE_DRAWS.items())
    return f"""
drawn AS (
  SELECT 'SUBJ' || lpad(c_custkey::VARCHAR, 9, '0') AS subject_id, {drawn},
    {draw_sql(synthetic.NOISE, 'u_noise')} AS u_noise
  FROM customer),
logits AS (
  SELECT *, (-2.5e0 + 0.55e0*((max_dpd_12m-45)/40e0) + 0.30e0*((max_dpd_24m-30)/30e0)
    + 0.75e0*(credit_utilization-0.5e0) + 0.45e0*((num_inquiries_12m-9)/5e0) + 0.30e0*(num_fintech_loans-2)
    + 0.25e0*(num_bnpl_accounts-2) + 0.38e0*(kol_status-3) + 0.18e0*(num_late_pmt_12m-5)
    + 0.80e0*(monthly_installment/nullif(monthly_income,0) - 0.5e0) - 0.015e0*(age-43)
    - 0.25e0*((monthly_income-31500000)/20000000e0) - 0.30e0*((avg_acct_age_months-60)/40e0)) AS latent_logit
  FROM drawn),
pds AS (SELECT *, 1e0/(1e0+exp(-latent_logit)) AS pd_true FROM logits),
wide AS (
  SELECT * EXCLUDE (u_noise, latent_logit), round(pd_true, 6) AS pd_true_prob,
    CASE WHEN u_noise < pd_true THEN 1 ELSE 0 END::BIGINT AS default_flag FROM pds)"""


BASE = ",".join([DIMENSIONS, APPLICATIONS, SUBJECTS, MART])


def credit(select: str, *ctes: str) -> str:
    """A query over the mapped credit tables."""
    return f"WITH {','.join([BASE, *ctes])}\n{select}"


def wide(select: str, *ctes: str) -> str:
    """A query over the wide subject table."""
    return f"WITH {','.join([wide_cte(), *ctes])}\n{select}"


def _grouped(by: str, measures: str, tail: str = "") -> str:
    names = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return credit(f"SELECT {names}{measures} FROM mart {group} {tail}")


N = "count(*) AS applications"
RATE = "round(100.0 * avg(is_approved), 1) AS approval_rate_pct"
DEFAULT = "round(100.0 * avg(default_flag), 2) AS default_rate_pct"
AVG_PD = "round(avg(pd_probability), 4) AS avg_pd"

APP_COLUMNS = """application_id, subject_id, app_date, region_code::BIGINT AS region_code, product_code,
  lender_code, channel, requested_amount::DOUBLE AS requested_amount, tenor_months::DOUBLE AS tenor_months, decision"""
SUBJECT_INTS = [
    "age", "region_code", "max_dpd_12m", "max_dpd_24m", "num_inquiries_12m", "num_fintech_loans",
    "num_bnpl_accounts", "num_active_loans", "kol_status", "num_late_pmt_12m", "avg_acct_age_months",
]
SUBJECT_WIDENED = "* REPLACE (" + ", ".join(f"{n}::BIGINT AS {n}" for n in SUBJECT_INTS) + ")"
AGE_GROUP = """CASE WHEN age > 20 AND age <= 30 THEN '21-30' WHEN age > 30 AND age <= 40 THEN '31-40'
  WHEN age > 40 AND age <= 50 THEN '41-50' WHEN age > 50 AND age <= 60 THEN '51-60'
  WHEN age > 60 AND age <= 70 THEN '61+' END"""
UTIL_BAND = """CASE WHEN credit_utilization > 0 AND credit_utilization <= 0.3 THEN 'Low'
  WHEN credit_utilization > 0.3 AND credit_utilization <= 0.6 THEN 'Med'
  WHEN credit_utilization > 0.6 AND credit_utilization <= 0.9 THEN 'High'
  WHEN credit_utilization > 0.9 AND credit_utilization <= 1.2 THEN 'Over' END"""
DTI = "monthly_installment / (CASE WHEN monthly_income = 0 THEN 1 ELSE monthly_income END)"
APPROVED = "avg(CASE WHEN decision = 'APPROVE' THEN 1e0 ELSE 0e0 END)"
AVG_AMOUNT = "round(sum(requested_amount)::DOUBLE / count(requested_amount), 4)"


def hash32(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key}::VARCHAR || ':{salt}'), 1, 8))::BIGINT"


def _flags(column: str, values: list, prefix: str) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1e0 ELSE 0e0 END AS {prefix}_{v.lower()}" for v in sorted(values)
    )


def _scoring_columns() -> str:
    flags = ", ".join(_flags(col, values, col) for col, values in fv.SCORING_CATEGORIES.items())
    return f"subject_id, {flags}, {', '.join(fv.SCORING_NUMERICS)}, round({DTI}, 9) AS dti_ratio"


def _trend(period: str, step: str) -> str:
    return credit(
        f"""SELECT period, coalesce(total, 0) AS total, coalesce(approved, 0) AS approved, avg_amount,
              round(approved / nullif(total, 0), 9) AS approval_rate
            FROM (SELECT unnest(generate_series(min(period)::TIMESTAMP, max(period)::TIMESTAMP, INTERVAL {step}))::DATE AS period FROM present)
            LEFT JOIN present USING (period)""",
        f"""present AS (SELECT {period} AS period, count(*) AS total,
              count(*) FILTER (decision = 'APPROVE') AS approved, {AVG_AMOUNT} AS avg_amount
            FROM apps GROUP BY 1)""",
    )


def _crosstab(row: str, col: str, values: list[str]) -> str:
    cells = ", ".join(f"""count(*) FILTER ({col} = '{v}') AS "{v}" """ for v in values)
    return credit(
        f"""SELECT CASE WHEN grouping({row}) = 1 THEN 'All' ELSE {row}::VARCHAR END AS {row}, {cells}, count(*) AS "All"
            FROM apps WHERE {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY ROLLUP({row})"""
    )


def _matrix(source: str, row: str, col: str, value: str, values: list[str]) -> str:
    cells = ", ".join(f"""round(avg({value}) FILTER ({col} = '{v}'), 9) AS "{v}" """ for v in values)
    return f"SELECT {row}, {cells} FROM {source} WHERE {row.split('::')[0]} IS NOT NULL AND {col} IS NOT NULL GROUP BY ALL"


RANKED = """
by_score AS (SELECT pd_true_prob AS s, count(*) FILTER (default_flag = 1) AS p, count(*) FILTER (default_flag = 0) AS n
  FROM subjects GROUP BY 1),
cum AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER () AS tp, sum(n) OVER () AS tn
  FROM by_score WINDOW w AS (ORDER BY s))"""
AUC = "sum(p * (cn - n + n / 2e0)) / (max(tp)::DOUBLE * max(tn))"

REPORT_COUNTS = """
classified AS (SELECT default_flag AS a, CASE WHEN pd_true_prob >= 0.30 THEN 1 ELSE 0 END AS b FROM subjects),
per_class AS (
  SELECT k, count(*) FILTER (a = k AND b = k) AS tp, count(*) FILTER (b = k) AS pp, count(*) FILTER (a = k) AS support,
    count(*) AS n
  FROM classified, (VALUES (0), (1)) v(k) GROUP BY k),
scored AS (
  SELECT *, coalesce(tp / nullif(pp, 0)::DOUBLE, 0) AS pr, coalesce(tp / nullif(support, 0)::DOUBLE, 0) AS rc,
    coalesce(2 * tp / nullif(pp + support, 0)::DOUBLE, 0) AS f FROM per_class)"""

EVENT_DAY = "scored_at::DATE"


def _drift(columns: list[str], digits: int) -> str:
    parts = [
        f"""SELECT day, '{col}' AS feature, n, round(m, {digits}) AS mean, round(b, {digits}) AS baseline_mean,
              round(m - b, {digits}) AS difference
            FROM (SELECT scored_at::DATE AS day, count({col}) AS n, avg({col}) AS m FROM predictions
                  WHERE scored_at >= TIMESTAMP '2024-01-11' AND scored_at < TIMESTAMP '2024-01-31'
                    AND scored_at >= TIMESTAMP '2023-12-31' GROUP BY 1),
                 (SELECT avg({col}) AS b FROM predictions WHERE scored_at < TIMESTAMP '2024-01-11')"""
        for col in columns
    ]
    return credit(" UNION ALL ".join(parts))


def _nearest(percent: int, ordered: str = "v") -> str:
    return f"{ordered}[round_even({percent / 100!r}::DOUBLE * (len({ordered}) - 1), 0)::BIGINT + 1]"


def _metric(name: str) -> str:
    table, expression = {
        "total_applications": ("apps", "count(application_id)"),
        "approval_rate": ("apps", f"round({APPROVED}, 9)"),
        "avg_loan_amount": ("apps", AVG_AMOUNT),
        "total_loan_amount": ("apps", "sum(requested_amount)::DOUBLE"),
        "avg_tenor": ("apps", "round(sum(tenor_months)::DOUBLE / count(tenor_months), 6)"),
        "total_subjects": ("subjects", "count(subject_id)"),
        "default_rate": ("subjects", "round(avg(default_flag), 9)"),
        "avg_pd": ("subjects", "round(avg(pd_true_prob), 12)"),
        "avg_income": ("subjects", "round(avg(monthly_income), 4)"),
        "avg_utilization": ("subjects", "round(avg(credit_utilization), 9)"),
        "avg_dti": ("subjects", "round(avg(monthly_installment / nullif(monthly_income, 0)), 6)"),
        "avg_dpd_12m": ("subjects", "round(avg(max_dpd_12m), 6)"),
        "avg_num_loans": ("subjects", "round(avg(num_active_loans), 6)"),
    }[name]
    return credit(
        f"SELECT region_code::BIGINT AS region, {expression} AS {name} FROM {table} GROUP BY region_code"
    )


def _univariate(keep: int = 30) -> str:
    names = [n for n, d in WIDE_DRAWS.items() if d.kind != "choice"]
    casts = ", ".join(f"{n}::DOUBLE AS {n}" for n in names)
    return wide(
        f"""SELECT feature, round(strength, 9) AS strength FROM (
              SELECT feature, abs(sum(p * (cn - n + n / 2e0)) / (max(tp)::DOUBLE * max(tn)) - 0.5) AS strength
              FROM cum GROUP BY feature)
            ORDER BY round(strength, 12) DESC, feature LIMIT {keep}""",
        f"""long AS (UNPIVOT (SELECT default_flag, {casts} FROM wide) ON {', '.join(names)} INTO NAME feature VALUE s),
        by_score AS (SELECT feature, s, count(*) FILTER (default_flag = 1) AS p, count(*) FILTER (default_flag = 0) AS n
          FROM long GROUP BY ALL),
        cum AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY s) AS cn, sum(p) OVER f AS tp, sum(n) OVER f AS tn
          FROM by_score WINDOW f AS (PARTITION BY feature))""",
    )


def _core_select(extra: str = "") -> str:
    return f"SELECT subject_id, {extra}{', '.join(fv.CORE_FEATURES)}, round({DTI}, 9) AS dti_ratio FROM wide"


TEST_FLAGS = ", ".join(
    [
        _flags("gender", fv.GENDERS, "gender"),
        _flags("employment_type", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], "employment_type"),
        _flags("education", fv.EDUCATIONS, "education"),
    ]
)
PRODUCT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LOOKUP = "subject_id, age, region_code, monthly_income, credit_utilization, max_dpd_12m"
BUNDLE = """app_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND island_group IN ('AFRICA','ASIA','EUROPE') AND product_class = 'Secured' AND risk_segment IN ('Low','Medium')"""
SPLIT = f"{hash32('subject_id', 'split')} < {int(0.75 * 2**32)}"
SCALED = ["age", "monthly_income", "credit_utilization", "max_dpd_12m"]
MODELS = "(VALUES ('LogReg (stepwise)'), ('GBT (weighted)'), ('GBT (balanced)')) m(model)"


def _kpi_period(suffix: str, condition: str) -> str:
    return f"""count(*) FILTER ({condition}) AS total_applications_{suffix},
      round(100.0 * avg(is_approved) FILTER ({condition}), 1) AS approval_rate_pct_{suffix},
      round(avg(credit_score) FILTER ({condition})) AS avg_credit_score_{suffix},
      round(100.0 * avg(default_flag) FILTER ({condition}), 2) AS default_rate_pct_{suffix}"""


# The regions of the log and their odds, written out apart from the package's own lists.
REGION_CODES = "DKI JABAR JATENG JATIM BANTEN YOGYA BALI NTB SUMUT SUMSEL RIAU LAMPUNG KALTIM KALBAR SULSEL SULUT PAPUA MALUKU".split()
REGION_WEIGHTS = [11, 18, 17, 3, 11, 25, 15, 23, 28, 26, 8, 10, 8, 25, 25, 5, 16, 6]


def _application_log() -> str:
    """Loan applications drawn per order."""
    def u(name: str) -> str:
        return _uniform(name, "o_orderkey")

    def pick(name: str, options: list, weights: list | None = None) -> str:
        return draw_sql(Draw("choice", options=tuple(options), weights=tuple(weights or ())), name, "o_orderkey")

    amounts = " ".join(f"WHEN '{p}' THEN {a!r}::DOUBLE" for p, a in fv.PRODUCT_BASE_AMOUNT.items())
    return f"""WITH d AS (
      SELECT 'APP' || lpad(o_orderkey::VARCHAR, 8, '0') AS application_id,
        'SUBJ' || lpad(floor({u('subject')} * 1000000)::BIGINT::VARCHAR, 9, '0') AS subject_id,
        DATE '2025-01-01' + floor({u('day')} * 546)::INT AS app_date,
        {pick('region_code', REGION_CODES, REGION_WEIGHTS)} AS region_code,
        {pick('product_code', fv.PRODUCT_CODES, fv.PRODUCT_WEIGHTS)} AS product_code,
        {pick('lender_code', fv.LENDER_CODES)} AS lender_code,
        {pick('channel', fv.CHANNELS, fv.CHANNEL_WEIGHTS)} AS channel,
        {pick('tenor', fv.TENORS)}::DOUBLE AS tenor_months,
        {u('amount')} AS ua, {u('decision')} AS ud
      FROM orders),
    e AS (SELECT *, 0.62e0 + CASE WHEN channel IN ('Branch','Agent') THEN 0.08e0 ELSE -0.03e0 END
        + CASE WHEN product_code IN ('KPR','KKB') THEN 0.05e0 ELSE -0.04e0 END AS ok FROM d)
    SELECT application_id, subject_id, app_date, region_code, product_code, lender_code, channel,
      round(CASE product_code {amounts} END * (0.4e0 + 1.4e0 * ua) / 10000) * 10000 AS requested_amount, tenor_months,
      CASE WHEN ud < ok THEN 'APPROVE' WHEN ud < ok + 0.15e0 THEN 'REVIEW' ELSE 'REJECT' END AS decision
    FROM e"""


UPSERT = credit(
    """SELECT coalesce(b.subject_id, ch.subject_id) AS subject_id, b.age::BIGINT AS age,
         coalesce(ch.cu, b.credit_utilization) AS credit_utilization,
         coalesce(coalesce(b.num_inquiries_12m, 0) + ch.inq, b.num_inquiries_12m)::BIGINT AS num_inquiries_12m
       FROM (SELECT * FROM subjects WHERE monthly_income > 0) b FULL JOIN ch ON ch.subject_id = b.subject_id""",
    """ch AS (SELECT user_id AS subject_id, round(max(value) FILTER (event_type = 'purchase') / 1000, 3) AS cu,
         count(*) FILTER (event_type = 'signup') AS inq FROM events GROUP BY 1)""",
)


# Tiles that the monthly pre-aggregate holds too; their rows are the same.
MONTHLY_TILES = [
    "kpi_total_applications", "kpi_approval_rate", "kpi_avg_credit_score", "kpi_default_rate", "monthly_volume",
    "monthly_by_decision", "volume_by_island", "product_class_by_decision", "risk_mix", "heat_default_island_class",
    "heat_volume_band_channel", "region_risk_bubble", "monthly_by_island", "top10_regions",
]


def oracles() -> dict[str, str]:
    found = _oracles()
    return found | {f"{name}_monthly": found[name] for name in MONTHLY_TILES}


def _oracles() -> dict[str, str]:
    return {
        # scans, sources, sinks
        "csv_ingest": "SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, event_type, props FROM events",
        "typed_load": credit(
            """SELECT application_id, subject_id::VARCHAR AS subject_id, app_date, region_code::VARCHAR AS region_code,
               product_code, lender_code::VARCHAR AS lender_code, channel, requested_amount::DOUBLE AS requested_amount,
               tenor_months::DOUBLE AS tenor_months, decision FROM apps"""
        ),
        "append_load": credit(
            """SELECT lender_code::VARCHAR AS lender_code, lender_name, lender_type FROM dim_lender
               UNION ALL SELECT lender_code::VARCHAR, lender_name, lender_type FROM dim_lender"""
        ),
        "ctas_overwrite": _grouped("app_month, decision", N),
        "named_view": credit("SELECT application_id, island_group, risk_segment, score_band FROM mart"),
        "table_scan": credit(f"SELECT {APP_COLUMNS} FROM apps"),
        "row_count_validation": credit(
            """SELECT 'DIM_REGION' AS table_name, count(*) AS row_count FROM dim_region
               UNION ALL SELECT 'DIM_PRODUCT', count(*) FROM dim_product
               UNION ALL SELECT 'DIM_LENDER', count(*) FROM dim_lender
               UNION ALL SELECT 'LOAN_APPLICATIONS', count(*) FROM apps
               UNION ALL SELECT 'MART_APPLICATIONS', count(*) FROM mart
               UNION ALL SELECT 'MART_APP_MONTHLY', count(*) FROM (
                 SELECT DISTINCT app_month, app_year, region_name, island_group, product_name, product_class,
                   lender_type, channel, decision, risk_segment, score_band FROM mart)"""
        ),
        "sample_exact_n": credit(
            f"SELECT application_id, decision FROM apps ORDER BY {hash32('application_id', 'sample')}, application_id LIMIT 5000"
        ),
        "synthetic_features": wide("SELECT * REPLACE (round(pd_true, 9) AS pd_true) FROM wide"),
        "synthetic_applications": _application_log(),
        "feature_table_write": wide(f"SELECT subject_id, {', '.join(fv.LOOKUP_FEATURES)} FROM wide"),
        "pk_check": "SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR l_orderkey IS NULL",
        # projections
        "select_core_features": wide(_core_select()),
        "select_exclude": credit(f"SELECT {SUBJECT_WIDENED[:-1]}) FROM (SELECT * EXCLUDE (pd_true_prob, default_flag) FROM subjects)"),
        "lateral_alias": credit(
            """SELECT subject_id, round(x, 6) AS installment_ratio,
                 round(CASE WHEN x IS NULL OR x > 3 THEN 3e0 ELSE x END, 9) AS capped_ratio
               FROM (SELECT subject_id, monthly_installment / nullif(monthly_income, 0) AS x FROM subjects)"""
        ),
        "dti_feature": credit(f"SELECT subject_id, round({DTI}, 6) AS dti_ratio FROM subjects"),
        "dti_nullable": credit("SELECT subject_id, round(monthly_installment / nullif(monthly_income, 0), 6) AS dti FROM subjects"),
        "onehot_view": wide(f"SELECT {_scoring_columns()} FROM wide"),
        "credit_score": credit("SELECT subject_id, 300 + round(550 * (1 - pd_true_prob)) AS credit_score FROM subjects"),
        "decision_band": credit(
            """SELECT subject_id, CASE WHEN pd_true_prob < 0.10 THEN 'APPROVE' WHEN pd_true_prob < 0.30 THEN 'REVIEW'
               ELSE 'REJECT' END AS decision FROM subjects"""
        ),
        "score_band": credit("SELECT application_id, credit_score, score_band FROM mart"),
        "risk_segment": credit("SELECT application_id, pd_probability, risk_segment FROM mart"),
        "approved_flag": credit("SELECT application_id, decision, (decision = 'APPROVE')::BIGINT AS is_approved FROM apps"),
        "calendar_cols": credit("SELECT application_id, app_date, app_month, app_week, app_year FROM mart"),
        "age_band": credit(f"SELECT subject_id, age::BIGINT AS age, {AGE_GROUP} AS age_group FROM subjects"),
        "util_band": credit(f"SELECT subject_id, credit_utilization, {UTIL_BAND} AS util_band FROM subjects"),
        "logit_pd": wide("SELECT subject_id, round(latent_logit, 9) AS latent_logit, round(1e0/(1e0+exp(-latent_logit)), 6) AS pd_true_prob FROM logits"),
        "bernoulli_label": credit(
            f"""SELECT subject_id, ({hash32('subject_id', 'default')} / 4294967296e0 < pd_true_prob)::BIGINT AS label
                FROM subjects"""
        ),
        "uniform_draws": wide(f"SELECT subject_id, {', '.join(synthetic.CORE_DRAWS)} FROM drawn"),
        "subject_key": "SELECT c_custkey, 'SUBJ' || lpad(c_custkey::VARCHAR, 9, '0') AS subject_key FROM customer",
        "clean_column_names": """SELECT event_id AS "EVENT_ID", event_type AS "EVENT_TYPE", user_id AS "USER_ID",
             user_id AS "USER_ID_1", value AS "VALUE_X" FROM events""",
        "split_by_dtype": credit(
            " UNION ALL ".join(
                f"SELECT '{n}' AS column_name, '{kind}' AS kind, count({n}) AS n_values FROM subjects"
                for n, kind in [("gender", "categorical"), ("employment_type", "categorical"), ("education", "categorical")]
                + [(n, "numeric") for n in SUBJECT_INTS
                   + ["monthly_income", "monthly_installment", "credit_utilization", "pd_true_prob"]]
            )
        ),
        "fillna_zero": credit(
            """SELECT application_id, coalesce(tenor_months, 0)::DOUBLE AS tenor_months, coalesce(lender_code, 0) AS lender_code
               FROM apps"""
        ),
        "add_scored_at": credit(
            "SELECT subject_id, TIMESTAMP '2024-01-31 00:00:00' AS scored_at, 'V2_SPARK_ML' AS model_version FROM subjects"
        ),
        # filters
        "lookup_one": wide(f"SELECT {LOOKUP} FROM wide WHERE subject_id = 'SUBJ000000042'"),
        "lookup_many": wide(
            f"""SELECT {LOOKUP} FROM wide WHERE subject_id IN
                (SELECT 'SUBJ' || lpad(user_id::VARCHAR, 9, '0') FROM events)"""
        ),
        "lookup_list": wide(
            f"SELECT {LOOKUP} FROM wide WHERE subject_id IN ('SUBJ000000007','SUBJ000000042','SUBJ000000099','SUBJ999999999')"
        ),
        "count_by_secondary": wide("SELECT count(*) AS n_in_region FROM wide WHERE region_code = 'DKI'"),
        "filter_bundle": credit(
            f"""SELECT application_id, app_date, island_group, product_class, channel, risk_segment FROM mart WHERE {BUNDLE}"""
        ),
        "filter_bundle_tile": credit(
            f"""SELECT lender_name, lender_type, {N}, {RATE}, {AVG_PD}, round(avg(credit_score)) AS avg_score, {DEFAULT}
                FROM mart WHERE {BUNDLE} GROUP BY ALL"""
        ),
        "relative_date_filter": credit(
            "SELECT application_id, app_date FROM apps WHERE app_date > DATE '1998-07-03' AND app_date <= DATE '1998-08-02'"
        ),
        "text_ilike": "SELECT doc_id, left(text, 60) AS preview FROM documents WHERE text ILIKE '%the%and%'",
        "recent_intervals": """SELECT event_id, ts, event_type FROM events
             WHERE ts >= TIMESTAMP '2024-01-30 21:58:00' AND ts <= TIMESTAMP '2024-01-30 23:58:00'
             ORDER BY ts DESC, event_id LIMIT 10""",
        "sidebar_filters": credit(
            """SELECT region_code::BIGINT AS region_code, count(*) AS applications FROM apps
               WHERE app_date >= DATE '1997-01-01' AND region_code IN (1,2,3,5,8) AND channel IN ('1-URGENT','5-LOW')
               GROUP BY 1"""
        ),
        "picker_bounds": credit("SELECT min(app_date) AS first_day, max(app_date) AS last_day FROM apps"),
        "filter_domain": credit("SELECT DISTINCT island_group FROM mart"),
        # joins
        "mart_applications": credit("SELECT * FROM mart"),
        "training_set": wide(_core_select("default_flag, ")),
        "encoded_lookup_join": credit(
            f"""SELECT event_id, subject_id, {TEST_FLAGS}, age::BIGINT AS age, monthly_income, credit_utilization,
                  kol_status::BIGINT AS kol_status, round({DTI}, 9) AS dti_ratio
                FROM events JOIN subjects ON subject_id = user_id WHERE monthly_income > 0"""
        ),
        "feature_upsert": UPSERT,
        # aggregates
        "feature_summary": credit(
            """SELECT count(*) AS n_rows, round(avg(default_flag), 4) AS default_rate, round(avg(pd_true_prob), 4) AS avg_pd_true
               FROM subjects"""
        ),
        "decision_summary": credit("SELECT decision, count(*) AS cnt, round(avg(pd_probability), 4) AS avg_pd FROM scores GROUP BY 1"),
        "kpi_total_applications": _grouped("", "count(*) AS total_applications"),
        "kpi_approval_rate": _grouped("", RATE),
        "kpi_avg_credit_score": _grouped("", "round(avg(credit_score)) AS avg_credit_score"),
        "kpi_default_rate": _grouped("", DEFAULT),
        "kpi_cards": credit(
            f"""SELECT * FROM (SELECT count(*) AS total_applications, round({APPROVED}, 9) AS approval_rate, {AVG_AMOUNT} AS avg_amount FROM apps),
                (SELECT round(avg(default_flag), 9) AS default_rate, round(avg(monthly_income), 4) AS avg_income,
                   round(avg(credit_utilization), 9) AS avg_utilization FROM subjects)"""
        ),
        "kpi_delta": credit(
            """SELECT *, round((total_applications_current - total_applications_prior)::DOUBLE, 2)::BIGINT AS total_applications_delta,
                 round(approval_rate_pct_current - approval_rate_pct_prior, 2) AS approval_rate_pct_delta,
                 round(avg_credit_score_current - avg_credit_score_prior, 2) AS avg_credit_score_delta,
                 round(default_rate_pct_current - default_rate_pct_prior, 2) AS default_rate_pct_delta
               FROM k""",
            f"""k AS (SELECT {_kpi_period('current', "app_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'")},
                {_kpi_period('prior', "app_date BETWEEN DATE '1997-10-01' AND DATE '1997-12-31'")} FROM mart)""",
        ),
        "monthly_volume": _grouped("app_month", N),
        "monthly_by_decision": _grouped("app_month, decision", N),
        "monthly_approval_rate": _grouped("app_month", f"{RATE}, 85::BIGINT AS target_pct"),
        "volume_by_island": _grouped("island_group", N),
        "product_class_by_decision": _grouped("product_class, decision", N),
        "decision_mix_by_channel": credit(
            f"""SELECT *, round(100.0 * applications / sum(applications) OVER (PARTITION BY channel), 4) AS share_pct
                FROM (SELECT channel, decision, {N} FROM mart GROUP BY ALL)"""
        ),
        "monthly_decision_share": credit(
            f"""SELECT *, round(100.0 * applications / sum(applications) OVER (PARTITION BY app_month), 4) AS share_pct
                FROM (SELECT app_month, decision, {N} FROM mart GROUP BY ALL)"""
        ),
        "channel_share": credit(
            f"""SELECT *, round(100.0 * applications / sum(applications) OVER (), 4) AS share_pct
                FROM (SELECT channel, {N} FROM mart GROUP BY ALL)"""
        ),
        "risk_mix": _grouped("risk_segment", N),
        "heat_default_island_class": _grouped("island_group, product_class", DEFAULT),
        "heat_volume_band_channel": _grouped("score_band, channel", N),
        "lender_performance": _grouped(
            "lender_name, lender_type", f"{N}, {RATE}, {AVG_PD}, round(avg(credit_score)) AS avg_score, {DEFAULT}"
        ),
        "region_risk_bubble": _grouped("region_name, island_group", f"{N}, {AVG_PD}, {RATE}"),
        "monthly_by_island": _grouped("app_month, island_group", N),
        "decision_stage_counts": credit(f"SELECT decision AS stage, {N} FROM mart GROUP BY 1"),
        "decision_funnel": credit(
            """SELECT stage_order::BIGINT AS stage_order, stage, count(application_id) AS applications,
                 round(100.0 * count(application_id) / (SELECT count(*) FROM apps WHERE decision = 'APPROVE'), 4) AS pct_of_first
               FROM (VALUES (1, 'APPROVE'), (2, 'REVIEW'), (3, 'REJECT')) v(stage_order, stage)
               LEFT JOIN apps ON decision = stage GROUP BY 1, 2"""
        ),
        "mart_app_monthly": credit(
            """SELECT app_month, app_year, region_name, island_group, product_name, product_class, lender_type, channel,
                 decision, risk_segment, score_band, count(*) AS n_applications, sum(is_approved)::BIGINT AS n_approved,
                 sum(requested_amount) AS total_requested, round(avg(requested_amount), 4) AS avg_requested,
                 round(avg(pd_probability), 9) AS avg_pd, round(avg(credit_score), 9) AS avg_credit_score,
                 round(avg(default_flag), 9) AS default_rate, round(sum(pd_probability), 6) AS sum_pd,
                 count(pd_probability) AS n_pd, sum(credit_score) AS sum_credit_score, count(credit_score) AS n_credit_score,
                 sum(default_flag)::BIGINT AS n_default, count(default_flag) AS n_default_known
               FROM mart GROUP BY ALL"""
        ),
        "monthly_trend_filled": _trend("date_trunc('month', app_date)::DATE", "1 MONTH"),
        "weekly_trend_filled": _trend("(app_date + ((7 - isodow(app_date)) % 7)::INT)::DATE", "7 DAYS"),
        "crosstab_margins": _crosstab("product_code", "decision", ["APPROVE", "REVIEW", "REJECT"]),
        "crosstab_lender_channel_long": credit(
            """SELECT CASE WHEN grouping(lender_code) = 1 THEN 'All' ELSE lender_code::VARCHAR END AS lender_code,
                 CASE WHEN grouping(channel) = 1 THEN 'All' ELSE channel END AS channel, count(*) AS n
               FROM apps WHERE lender_code IS NOT NULL AND channel IS NOT NULL GROUP BY CUBE (lender_code, channel)"""
        ),
        "crosstab_region_channel": _crosstab("region_code", "channel", PRIORITIES),
        "crosstab_lender_product": _crosstab("lender_code", "product_code", PRODUCT_TYPES),
        "heat_approval_region_product": credit(
            _matrix("apps", "region_code::BIGINT AS region_code", "product_code",
                    "CASE WHEN decision = 'APPROVE' THEN 1e0 ELSE 0e0 END", PRODUCT_TYPES)
        ),
        "default_rate_by_kol": credit(
            """SELECT kol_status::BIGINT AS kol_status, round(avg(default_flag), 9) AS default_rate, count(subject_id) AS n_subjects
               FROM subjects GROUP BY 1"""
        ),
        "pd_histogram": credit(
            """SELECT least(49, floor((pd_true_prob - lo) / ((hi - lo) / 50)))::BIGINT AS bin, default_flag::BIGINT AS default_flag, count(*) AS n
               FROM subjects, (SELECT min(pd_true_prob) AS lo, max(pd_true_prob) AS hi FROM subjects) GROUP BY 1, 2"""
        ),
        "heat_age_util": credit(
            _matrix("banded", "age_group", "util_band", "default_flag", ["Low", "Med", "High", "Over"]),
            f"banded AS (SELECT {AGE_GROUP} AS age_group, {UTIL_BAND} AS util_band, default_flag FROM subjects)",
        ),
        "top_regions_amount": credit(
            f"""SELECT region_code::BIGINT AS region_code, count(*) AS volume, {AVG_AMOUNT} AS avg_amount
                FROM apps GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
        ),
        "product_mix_amount": credit(
            """SELECT *, round(100.0 * total_amount / sum(total_amount) OVER (), 4) AS share_pct
               FROM (SELECT product_code, sum(requested_amount)::DOUBLE AS total_amount FROM apps GROUP BY 1)"""
        ),
        "monthly_by_product": credit(
            "SELECT date_trunc('month', app_date)::DATE AS app_month, product_code, count(*) AS applications FROM apps GROUP BY ALL"
        ),
        "region_volume_avg_amount": credit(
            f"SELECT region_code::BIGINT AS region_code, count(*) AS volume, {AVG_AMOUNT} AS avg_amount FROM apps GROUP BY 1"
        ),
        "util_income_scatter": credit(
            "SELECT subject_id, credit_utilization, monthly_income, default_flag::BIGINT AS default_flag FROM subjects"
        ),
        "latency_percentiles": f"""SELECT len(v) AS n, round(m, 6) AS mean_ms, {_nearest(50)} AS p50, {_nearest(95)} AS p95,
              {_nearest(99)} AS p99, round(len(v) * 1e6 / us, 9) AS per_second
            FROM (SELECT list(value ORDER BY value) AS v, avg(value) AS m, epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events)""",
        "log_stats": """SELECT count(*) AS n, round(avg(value), 6) AS avg_ms, round(median(value), 6) AS median,
              round(avg(user_id), 6) AS avg_user
            FROM events WHERE event_type = 'view' AND props ILIKE '%"K": 1%'""",
        "compare_two_logs": f"""SELECT event_type AS log, len(v) AS n, round(m, 6) AS avg_ms, round(med, 6) AS median,
              {_nearest(50)} AS p50, {_nearest(95)} AS p95
            FROM (SELECT event_type, list(value ORDER BY value) AS v, avg(value) AS m, median(value) AS med
                  FROM events WHERE event_type IN ('click','purchase') GROUP BY 1)""",
        # sorts and limits
        "top10_regions": _grouped("region_name", N, "ORDER BY applications DESC, region_name LIMIT 10"),
        "top5_lenders": _grouped("lender_name", N, "ORDER BY applications DESC, lender_name NULLS FIRST LIMIT 5"),
        "preview_limit": credit("SELECT subject_id, pd_probability, credit_score, decision FROM scores ORDER BY subject_id LIMIT 1000"),
        # model data
        "onehot_fit_transform": credit(
            f"""SELECT * EXCLUDE (gender, employment_type, education) REPLACE ({', '.join(f'{n}::BIGINT AS {n}' for n in SUBJECT_INTS)},
                  default_flag::BIGINT AS default_flag), {TEST_FLAGS} FROM subjects"""
        ),
        "standard_scale": credit(
            "SELECT subject_id, " + ", ".join(f"round(({n} - m_{n}) / s_{n}, 9) AS {n}" for n in SCALED)
            + f" FROM subjects, fitted WHERE NOT ({SPLIT})",
            "fitted AS (SELECT " + ", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in SCALED)
            + f" FROM subjects WHERE {SPLIT})",
        ),
        "random_split": credit(f"SELECT subject_id, CASE WHEN {SPLIT} THEN 'train' ELSE 'test' END AS part FROM subjects"),
        "stratified_split": credit(
            f"""SELECT subject_id, default_flag::BIGINT AS default_flag FROM subjects
                QUALIFY row_number() OVER (PARTITION BY default_flag ORDER BY {hash32('subject_id', 'stratified')}, subject_id)
                  <= round(0.7 * count(*) OVER (PARTITION BY default_flag))"""
        ),
        "univariate_auc_rank": _univariate(),
        "auc_gini": credit(
            f"""SELECT max(tp)::BIGINT AS n_pos, max(tn)::BIGINT AS n_neg, round({AUC}, 9) AS auc, round(2 * {AUC} - 1, 9) AS gini FROM cum""",
            RANKED,
        ),
        "ks_statistic": credit("SELECT round(max(abs(cp::DOUBLE / tp - cn::DOUBLE / tn)), 9) AS ks FROM cum", RANKED),
        "roc_curve": credit(
            """SELECT s AS threshold, round((tn - cn + n)::DOUBLE / tn, 9) AS fpr, round((tp - cp + p)::DOUBLE / tp, 9) AS tpr FROM cum
               UNION ALL SELECT 'inf'::DOUBLE, 0, 0""",
            RANKED,
        ),
        "confusion_matrix": credit(
            "SELECT a::BIGINT AS actual, b::BIGINT AS predicted, count(*) AS n FROM classified GROUP BY 1, 2", REPORT_COUNTS
        ),
        "classification_report": credit(
            """SELECT k::VARCHAR AS class, round(pr, 9) AS precision, round(rc, 9) AS recall, round(f, 9) AS f1, support FROM scored
               UNION ALL SELECT 'accuracy', round(sum(tp) / max(n), 9), round(sum(tp) / max(n), 9), round(sum(tp) / max(n), 9), max(n) FROM scored
               UNION ALL SELECT 'macro avg', round(avg(pr), 9), round(avg(rc), 9), round(avg(f), 9), max(n) FROM scored
               UNION ALL SELECT 'weighted avg', round(sum(pr * support) / max(n), 9), round(sum(rc * support) / max(n), 9),
                 round(sum(f * support) / max(n), 9), max(n) FROM scored""",
            REPORT_COUNTS,
        ),
        "score_batch": wide(
            """SELECT subject_id, pd_true_prob AS pd_probability, 300 + round(550 * (1 - pd_true_prob)) AS credit_score,
                 CASE WHEN pd_true_prob < 0.10 THEN 'APPROVE' WHEN pd_true_prob < 0.30 THEN 'REVIEW' ELSE 'REJECT' END AS decision,
                 TIMESTAMP '2024-01-31 00:00:00' AS scored_at, 'V2_SPARK_ML' AS model_version FROM wide"""
        ),
        # trained models: the rows, and what must hold of the fitted values
        **{
            f"train_gbt_{kind}": wide(f"SELECT subject_id, default_flag::BIGINT AS default_flag, true AS score_in_range, true AS class_follows, true AS above_chance FROM wide WHERE NOT ({SPLIT})")
            for kind in ("weighted", "balanced")
        },
        "train_logreg_stepwise": wide(
            f"""SELECT subject_id, default_flag::BIGINT AS default_flag, true AS score_in_range, true AS class_follows, true AS above_chance,
                  true AS at_optimum, true AS gains_hold FROM wide WHERE NOT ({SPLIT})"""
        ),
        "model_comparison": f"""SELECT model, true AS gini_follows, true AS auc_agrees, true AS above_chance, true AS halfway_to_truth, true AS below_truth
            FROM {MODELS}""",
        "rank_models": "SELECT unnest([1, 2, 3])::BIGINT AS place, true AS not_better_than_the_last, true AS known",
        "roc_long": f"""SELECT model, true AS from_the_origin, true AS to_one, true AS never_falls, true AS area_is_auc FROM {MODELS}""",
        "predict_sample": wide(
            f"SELECT subject_id, true AS score_in_range, true AS class_follows, true AS above_chance FROM wide WHERE NOT ({SPLIT}) ORDER BY subject_id LIMIT 10"
        ),
        "score_batch_model": wide(
            """SELECT subject_id, true AS pd_in_range, true AS score_follows, true AS decision_follows,
                 TIMESTAMP '2024-01-31 00:00:00' AS scored_at, 'V2_SPARK_ML' AS model_version FROM wide"""
        ),
        "monitor_predicted_class": wide(
            f"""SELECT subject_id, default_flag::BIGINT AS default_flag, true AS class_known,
                  CASE WHEN {SPLIT} THEN TIMESTAMP '2026-07-01' ELSE TIMESTAMP '2026-07-15' END AS scored_at,
                  CASE WHEN {SPLIT} THEN 'baseline' ELSE 'source' END AS part FROM wide"""
        ),
        "drift_predicted_class": wide(
            f"""SELECT DATE '2026-07-15' AS day, 'prediction' AS feature, count(*) AS n, true AS difference_follows,
                  true AS means_are_shares FROM wide WHERE NOT ({SPLIT})"""
        ),
        # feature views, drift
        "feature_view": wide(_core_select()),
        "dataset_snapshot": wide(_core_select("default_flag, ")),
        "monitor_tables": credit(
            """SELECT * REPLACE (default_flag::BIGINT AS default_flag),
                 CASE WHEN scored_at < TIMESTAMP '2024-01-11' THEN 'baseline' ELSE 'source' END AS part FROM predictions"""
        ),
        "drift_difference_of_means": _drift(["pd_true_prob"], 9),
        "feature_drift": _drift(["value", "pd_true_prob", "default_flag"], 6),
        **dict.fromkeys(("performance_by_window", "stream_performance"), credit(
            """SELECT day, max(n_day) AS n, round(max(acc), 9) AS accuracy,
                 round(sum(p * (cn - n + n / 2e0)) / nullif(max(tp)::DOUBLE * max(tn), 0), 9) AS auc FROM cum_day
               JOIN (SELECT scored_at::DATE AS day, count(*) AS n_day,
                       avg(((pd_true_prob >= 0.30)::INT = default_flag)::INT) AS acc FROM predictions
                     WHERE default_flag IS NOT NULL GROUP BY 1) USING (day) GROUP BY day""",
            """by_day AS (SELECT scored_at::DATE AS day, pd_true_prob AS s, count(*) FILTER (default_flag = 1) AS p,
                 count(*) FILTER (default_flag = 0) AS n FROM predictions WHERE default_flag IS NOT NULL GROUP BY 1, 2),
               cum_day AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY s) AS cn, sum(p) OVER d AS tp, sum(n) OVER d AS tn
                 FROM by_day WINDOW d AS (PARTITION BY day))""",
        )),
        # streams: the same results as the batch jobs
        "stream_score": credit(
            """SELECT event_id, user_id AS subject_id, pd_probability, credit_score, decision
               FROM events LEFT JOIN scores ON subject_id = user_id"""
        ),
        "stream_drift": _drift(["value"], 6),
        "stream_feature_refresh": UPSERT,
        # metrics and questions
        **dict.fromkeys(("metric_query", "metric_query_rollup"), credit(
            f"""SELECT channel, decision, date_trunc('quarter', app_date)::DATE AS period, count(*) AS total_applications,
                  round({APPROVED}, 9) AS approval_rate, {AVG_AMOUNT} AS avg_loan_amount,
                  sum(requested_amount)::DOUBLE AS total_loan_amount,
                  round(sum(tenor_months)::DOUBLE / count(tenor_months), 6) AS avg_tenor
                FROM apps GROUP BY ALL"""
        )),
        "metric_query_subjects": credit(
            """SELECT gender, education, count(*) AS total_subjects, round(avg(default_flag), 9) AS default_rate,
                 round(avg(pd_true_prob), 12) AS avg_pd, round(avg(monthly_income), 4) AS avg_income,
                 round(avg(credit_utilization), 9) AS avg_utilization,
                 round(avg(monthly_installment / nullif(monthly_income, 0)), 6) AS avg_dti,
                 round(avg(max_dpd_12m), 6) AS avg_dpd_12m, round(avg(num_active_loans), 6) AS avg_num_loans
               FROM subjects GROUP BY ALL"""
        ),
        **{
            f"m_{name}": _metric(name)
            for name in [
                "total_applications", "approval_rate", "avg_loan_amount", "total_loan_amount", "avg_tenor",
                "total_subjects", "default_rate", "avg_pd", "avg_income", "avg_utilization", "avg_dti",
                "avg_dpd_12m", "avg_num_loans",
            ]
        },
        "q_monthly_2025": credit(
            """SELECT date_trunc('month', app_date)::DATE AS period, count(*) AS total_applications FROM apps
               WHERE year(app_date) = 1997 GROUP BY 1"""
        ),
        "q_default_by_kol": credit("SELECT kol_status::BIGINT AS kol_status, round(avg(default_flag), 9) AS default_rate FROM subjects GROUP BY 1"),
        "q_avg_amount_by_product": credit(f"SELECT product_code AS product, {AVG_AMOUNT} AS avg_loan_amount FROM apps GROUP BY 1"),
        "q_region_most_reject": credit(
            """SELECT region_code::BIGINT AS region, count(*) AS total_applications FROM apps WHERE decision = 'REJECT'
               GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""
        ),
        "q_approval_by_region": _metric("approval_rate"),
        "q_channel_trend": credit(
            "SELECT channel, date_trunc('month', app_date)::DATE AS period, count(*) AS total_applications FROM apps GROUP BY ALL"
        ),
        "q_last_month_total": credit(
            "SELECT count(*) AS total_applications FROM apps WHERE app_date BETWEEN DATE '1998-07-01' AND DATE '1998-07-31'"
        ),
        "q_approval_product_channel": credit(
            _matrix("apps", "product_code", "channel", "CASE WHEN decision = 'APPROVE' THEN 1e0 ELSE 0e0 END", PRIORITIES)
        ),
        "q_avg_pd_kol3": credit("SELECT round(avg(pd_true_prob), 12) AS avg_pd FROM subjects WHERE kol_status = 3"),
        "q_bnpl_vs_kta": credit(
            """SELECT date_trunc('month', app_date)::DATE AS period, count(*) FILTER (product_code = 'PROMO') AS "PROMO",
                 count(*) FILTER (product_code = 'ECONOMY') AS "ECONOMY"
               FROM apps WHERE product_code IN ('PROMO','ECONOMY') GROUP BY 1"""
        ),
        "q_income_by_default": credit("SELECT default_flag::BIGINT AS default_flag, round(avg(monthly_income), 4) AS avg_income FROM subjects GROUP BY 1"),
        "q_util_by_region": _metric("avg_utilization"),
        "q_default_by_age": credit(
            f"SELECT {AGE_GROUP} AS age_group, round(avg(default_flag), 9) AS default_rate, count(*) AS n_subjects FROM subjects GROUP BY 1"
        ),
        "q_island_unsecured_default": credit(
            """SELECT island_group, round(100.0 * avg(default_flag), 4) AS default_rate_pct FROM mart
               WHERE product_class = 'Unsecured' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""
        ),
        "q_reject_by_channel": credit("SELECT channel, count(*) AS applications FROM mart WHERE decision = 'REJECT' GROUP BY 1"),
        "q_approval_change": credit(
            """SELECT product_class, count(*) FILTER (cur) AS n_now, count(*) FILTER (NOT cur) AS n_before,
                 round(avg(is_approved) FILTER (cur), 6) AS rate_now, round(avg(is_approved) FILTER (NOT cur), 6) AS rate_before,
                 round(coalesce(sum(is_approved) FILTER (cur), 0)::DOUBLE / (SELECT count(*) FROM q WHERE cur)
                   - coalesce(sum(is_approved) FILTER (NOT cur), 0)::DOUBLE / (SELECT count(*) FROM q WHERE NOT cur), 6) AS contribution
               FROM q GROUP BY 1""",
            """q AS (SELECT *, app_date >= DATE '1998-01-01' AS cur FROM mart
                 WHERE app_date >= DATE '1997-10-01' AND app_date < DATE '1998-04-01')""",
        ),
    }
