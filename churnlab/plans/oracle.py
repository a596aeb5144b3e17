"""DuckDB SQL for the independent oracle.

Each adapter view and derived frame is written once here as a CTE body, in
plain SQL, independently of the DataFrame code. ``with_views`` prepends the
CTEs a query needs (dependencies first).
"""

from __future__ import annotations

AS_OF_TS = "TIMESTAMP '1999-01-01 00:00:00'"
AS_OF_DATE = "DATE '1999-01-01'"


def ymd(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def parse_ymd(expr: str) -> str:
    return f"CAST(try_strptime(CAST({expr} AS VARCHAR), '%Y%m%d') AS DATE)"


def hash_unit(key_expr: str, salt: str) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(CAST({key_expr} AS VARCHAR) || '|{salt}'), 1, 8)) AS BIGINT) % 1000000"
            f" AS DOUBLE) / 1000000.0")


def mode_sql(table: str, key: str, expr: str, alias: str) -> str:
    """Most frequent non-null value per key; ties -> smallest value."""
    return f"""(SELECT {key}, v AS {alias} FROM (
        SELECT {key}, v, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v ASC) AS rn
        FROM (SELECT {key}, {expr} AS v, count(*) AS n FROM {table} WHERE {expr} IS NOT NULL GROUP BY 1, 2)
    ) WHERE rn = 1)"""


_PLAN_DAYS = "CASE WHEN o_orderkey % 20 < 15 THEN 30 WHEN o_orderkey % 20 < 19 THEN 7 ELSE 90 END"
_METHOD = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, deps: list[str], body: str) -> None:
    VIEWS[name] = (deps, body)


view("transactions", [], f"""
SELECT CAST(o_custkey AS VARCHAR) AS msno,
       {_METHOD} AS payment_method_id,
       CAST({_PLAN_DAYS} AS INTEGER) AS payment_plan_days,
       CAST(round(o_totalprice) AS BIGINT) AS plan_list_price,
       CAST(round(o_totalprice) AS BIGINT) AS actual_amount_paid,
       CAST(CASE WHEN {_METHOD} <= 3 THEN 1 ELSE 0 END AS INTEGER) AS is_auto_renew,
       {ymd('CAST(o_orderdate AS DATE)')} AS transaction_date,
       {ymd(f'CAST(o_orderdate AS DATE) + CAST({_PLAN_DAYS} AS INTEGER)')} AS membership_expire_date,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS is_cancel
FROM orders WHERE o_orderdate < {AS_OF_TS}""")

view("members", [], f"""
SELECT CAST(c_custkey AS VARCHAR) AS msno,
       CAST(CASE WHEN c_custkey % 400 = 1 THEN 99 ELSE c_nationkey END AS INTEGER) AS city,
       CAST((c_custkey * 7) % 101 AS INTEGER) AS bd,
       CASE c_custkey % 3 WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS gender,
       CAST(CASE WHEN c_custkey % 300 = 0 THEN 13 ELSE 3 + c_custkey % 5 END AS INTEGER) AS registered_via,
       {ymd("DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER)")} AS registration_init_time
FROM customer""")

view("user_logs", [], f"""
SELECT CAST(user_id AS VARCHAR) AS msno, {ymd('CAST(ts AS DATE)')} AS date,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS num_25,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS num_50,
       CAST(count(*) FILTER (WHERE event_type = 'signup') AS INTEGER) AS num_75,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS INTEGER) AS num_985,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS INTEGER) AS num_100,
       CAST(count(DISTINCT props) AS INTEGER) AS num_unq,
       sum(value) AS total_secs
FROM events GROUP BY 1, 2""")

view("train", [], f"""
SELECT msno, CAST(CASE WHEN nxt IS NOT NULL AND nxt <= last + 730 THEN 0 ELSE 1 END AS INTEGER) AS is_churn
FROM (SELECT CAST(o_custkey AS VARCHAR) AS msno,
             max(CASE WHEN o_orderdate < {AS_OF_TS} THEN CAST(o_orderdate AS DATE) END) AS last,
             min(CASE WHEN o_orderdate >= {AS_OF_TS} THEN CAST(o_orderdate AS DATE) END) AS nxt
      FROM orders GROUP BY 1) t
WHERE last IS NOT NULL""")

view("predictions", ["train"], f"""
SELECT msno, is_churn, score, CAST(CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
FROM (SELECT msno, is_churn,
             CAST(least(1.0, {hash_unit('msno', 'score')} + CAST(0.2 AS DOUBLE) * is_churn) AS DOUBLE) AS score
      FROM train) p""")

_QTR = f"quarter({parse_ymd('transaction_date')})"

view("txn_features", ["transactions"], f"""
SELECT b.msno, b.regist_trans, pm.mst_frq_pay_met, pd.mst_frq_plan_days, b.revenue, ar.is_auto_renew,
       b.regist_cancels, CAST(q.qtr_trans AS INTEGER) AS qtr_trans
FROM (SELECT msno, count(payment_method_id) AS regist_trans,
             CAST(sum(actual_amount_paid) AS BIGINT) AS revenue,
             CAST(sum(is_cancel) AS BIGINT) AS regist_cancels
      FROM transactions GROUP BY msno) b
LEFT JOIN {mode_sql('transactions', 'msno', 'payment_method_id', 'mst_frq_pay_met')} pm USING (msno)
LEFT JOIN {mode_sql('transactions', 'msno', 'payment_plan_days', 'mst_frq_plan_days')} pd USING (msno)
LEFT JOIN {mode_sql('transactions', 'msno', 'is_auto_renew', 'is_auto_renew')} ar USING (msno)
LEFT JOIN {mode_sql('transactions', 'msno', _QTR, 'qtr_trans')} q USING (msno)""")

view("members_filled", ["members"], """
SELECT msno, city, bd, coalesce(gender, 'other') AS gender, registered_via, registration_init_time FROM members""")

view("log_means", ["user_logs"], """
SELECT msno, avg(num_25) AS num_25, avg(num_50) AS num_50, avg(num_75) AS num_75, avg(num_985) AS num_985,
       avg(num_100) AS num_100, avg(num_unq) AS num_unq,
       avg(CASE WHEN total_secs > 0 THEN ln(total_secs) END) AS total_secs
FROM user_logs GROUP BY msno""")

view("features_joined", ["train", "txn_features", "members_filled", "log_means"], """
SELECT t.msno, t.is_churn, x.regist_trans, x.mst_frq_pay_met, x.mst_frq_plan_days, x.revenue, x.is_auto_renew,
       x.regist_cancels, x.qtr_trans, m.city, m.bd, m.gender, m.registered_via, m.registration_init_time,
       l.num_25, l.num_50, l.num_75, l.num_985, l.num_100, l.num_unq, l.total_secs
FROM train t LEFT JOIN txn_features x USING (msno) LEFT JOIN members_filled m USING (msno)
LEFT JOIN log_means l USING (msno)""")

view("aged", ["features_joined"], f"""
SELECT * REPLACE (CAST(coalesce(CASE WHEN bd > 80 THEN 0 ELSE bd END, 0) AS INTEGER) AS bd),
       datediff('day', {parse_ymd('registration_init_time')}, {AS_OF_DATE}) / 365.0 AS tenure
FROM features_joined""")

def _counts_body(base: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM {base}"
        for c in ("registered_via", "mst_frq_pay_met", "city"))
    return (f"SELECT feature, value, count(value) AS n, "
            f"count(value) / (SELECT CAST(count(*) AS DOUBLE) FROM {base}) AS share "
            f"FROM ({union}) GROUP BY feature, value")


def _kept(c: str, counts: str) -> str:
    return (f"coalesce((SELECT any_value(value) FROM {counts} k WHERE k.feature = '{c}' "
            f"AND k.share >= 0.005 AND k.value = CAST(a.{c} AS VARCHAR)), 'other')")


def _bucketed(counts: str) -> str:
    return ", ".join(f"{_kept(c, counts)} AS {c}" for c in ("registered_via", "mst_frq_pay_met", "city"))


view("category_counts", ["aged"], _counts_body("aged"))

view("features_clean", ["aged", "category_counts"], f"""
SELECT a.* REPLACE ({_bucketed('category_counts')},
                    ln(1 + regist_trans) AS regist_trans, ln(1 + mst_frq_plan_days) AS mst_frq_plan_days,
                    ln(1 + revenue) AS revenue, ln(1 + regist_cancels) AS regist_cancels)
FROM aged a""")


def _bucket(seed: int) -> str:
    return f"CAST(('0x' || substr(md5(msno || '|{seed}'), 1, 8)) AS BIGINT) % 1000000"


view("split", ["features_clean"], f"""
SELECT * EXCLUDE (registration_init_time, _b),
       CASE WHEN _b < 700000 THEN 'train' WHEN _b < 900000 THEN 'test' ELSE 'validation' END AS split
FROM (SELECT *, {_bucket(200)} AS _b FROM features_clean) s""")

IMPUTE = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs", "tenure"]
CATS = ["city", "gender", "registered_via", "qtr_trans", "mst_frq_pay_met", "is_auto_renew"]

view("imputed", ["split"], "SELECT * REPLACE (" + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM split WHERE split = 'train')) AS {c}" for c in IMPUTE)
    + ") FROM split")

for _c in CATS:
    view(f"vocab_{_c}", ["imputed"], f"""
SELECT value, row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS ix
FROM (SELECT coalesce(CAST({_c} AS VARCHAR), 'other') AS value, count(*) AS n
      FROM imputed WHERE split = 'train' GROUP BY 1) v""")

view("indexed", ["imputed"] + [f"vocab_{c}" for c in CATS], "SELECT a.* REPLACE (" + ", ".join(
    f"CAST(coalesce((SELECT ix FROM vocab_{c} v WHERE v.value = coalesce(CAST(a.{c} AS VARCHAR), 'other')), "
    f"(SELECT count(*) FROM vocab_{c})) AS DOUBLE) AS {c}" for c in CATS) + ") FROM imputed a")

view("class_balance", ["indexed"], """
SELECT count(*) FILTER (WHERE is_churn = 0) AS n_major, count(*) FILTER (WHERE is_churn = 1) AS n_minor,
       CAST(count(*) FILTER (WHERE is_churn = 0) // nullif(count(*) FILTER (WHERE is_churn = 1), 0) AS INTEGER) AS ratio
FROM indexed WHERE split = 'train'""")

FEATURES = ["msno", "is_churn", "regist_trans", "mst_frq_plan_days", "revenue", "regist_cancels", "bd", "tenure",
            "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs",
            "city", "gender", "registered_via", "qtr_trans", "mst_frq_pay_met", "is_auto_renew"]
FEATURE_DOUBLES = [c for c in FEATURES if c not in ("msno", "is_churn", "bd")]

view("final", ["indexed", "class_balance"], f"""
SELECT split, {", ".join(c if c in ("msno", "is_churn", "bd") else f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)}
FROM (SELECT i.*, unnest(range(CASE WHEN split = 'train' AND is_churn = 1
                                    THEN (SELECT greatest(coalesce(ratio, 1), 1) FROM class_balance) ELSE 1 END)) AS _rep
      FROM indexed i) r""")

# pandas path
view("eda_base", ["features_joined"], f"""
SELECT * REPLACE (CAST(coalesce(CASE WHEN bd > 80 THEN 0 ELSE bd END, 0) AS INTEGER) AS bd),
       datediff('day', {parse_ymd('registration_init_time')}, {AS_OF_DATE}) / 365.0 AS tenure
FROM features_joined
WHERE city IS NOT NULL AND gender IS NOT NULL AND registered_via IS NOT NULL AND registration_init_time IS NOT NULL""")

view("eda_counts", ["eda_base"], _counts_body("eda_base"))

view("eda", ["eda_base", "eda_counts"], f"""
SELECT a.* REPLACE ({_bucketed('eda_counts')}),
       CASE WHEN {_bucket(123)} < 800000 THEN 'train' ELSE 'test' END AS split
FROM eda_base a""")

LOGS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]
view("eda_imputed", ["eda"], "SELECT * REPLACE (" + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(median({c}) AS DOUBLE) FROM eda WHERE split = 'train')) AS {c}"
    for c in LOGS) + ") FROM eda")

OUTLIER = ["regist_trans", "regist_cancels", "total_secs", "tenure"]
view("eda_stats", ["eda_imputed"], "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in OUTLIER) + " FROM eda_imputed WHERE split = 'train'")
view("eda_inliers", ["eda_imputed", "eda_stats"], "SELECT " + ", ".join(
    f"avg(CASE WHEN abs(({c} - m_{c}) / s_{c}) < 3 THEN {c} END) AS in_{c}" for c in OUTLIER)
    + " FROM eda_imputed, eda_stats WHERE split = 'train'")
view("eda_tamed", ["eda_imputed", "eda_stats", "eda_inliers"], "SELECT i.* REPLACE (" + ", ".join(
    f"CASE WHEN split = 'train' AND abs(({c} - m_{c}) / s_{c}) > 3 THEN in_{c} ELSE CAST({c} AS DOUBLE) END AS {c}"
    for c in OUTLIER) + ") FROM eda_imputed i, eda_stats, eda_inliers")

SCALE = ["regist_trans", "mst_frq_plan_days", "revenue", "regist_cancels", "bd", "tenure"]
view("eda_scale_stats", ["eda_tamed"], "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE) + " FROM eda_tamed WHERE split = 'train'")
view("eda_scaled", ["eda_tamed", "eda_scale_stats"], "SELECT t.* REPLACE (" + ", ".join(
    f"(CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}" for c in SCALE)
    + ") FROM eda_tamed t, eda_scale_stats")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str) -> str:
    order = _order(list(names))
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"
