"""DuckDB SQL for the registered queries, written from the tables up.

Each entry is a chain of named subqueries ending in one SELECT. Ratios are
rounded in integer arithmetic, so no floating-point quotient is involved.
"""

from __future__ import annotations

import re

from tradeloom.workload.shapes import PLAN_COLUMNS, RAW, SOURCES, TYPED

# Words that mean "no key" and "no date".
WORDS = "('nan', 'none', 'null', '')"
# Cell texts that mean a missing value in delimited sources.
MISSING = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
    '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""
DATE_WORDS = "('', 'nan', 'none', 'null', 'nat')"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def varchar(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def pad(x: str, width: int = 3) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {width}, '0')"


def emp(x: str) -> str:
    return f"'E' || {pad(x, 10)}"


def ratio(num: str, den: str, scale: int = 2, mult: int = 100) -> str:
    """num * mult / den, rounded half away from zero; NULL unless den differs from 0."""
    def whole(x: str) -> str:
        return f"CAST(CAST(({x}) AS DECIMAL(24,4)) * 10000 AS HUGEINT)"

    n, d = whole(num), whole(den)
    factor = mult * 10**scale
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    units = f"({sign} * ((2 * abs({n}) * {factor} + abs({d})) // (2 * abs({d}))))"
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({units} AS DOUBLE) / 1e{scale} END)"


def ratio_text(num: str, den: str, mult: int = 1) -> str:
    return varchar(f"CAST({ratio(num, den, 2, mult)} AS DECIMAL(18,2))")


def lineage(number: str, batch: str = "0", minutes: str = "0") -> str:
    return f"""'SRC{number}' AS _source_file, 'tables' AS _source_platform,
        TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({batch} AS INTEGER)) + to_minutes(CAST({minutes} AS BIGINT)) AS _ingested_at,
        'batch-' || CAST({batch} + 1 AS VARCHAR) AS _batch_id"""


def twice(source: str, condition: str) -> str:
    return f"(SELECT *, 0 AS batch FROM {source} UNION ALL SELECT *, 1 AS batch FROM {source} WHERE {condition})"


def clean(x: str) -> str:
    return f"NULLIF(trim({x}, ' '), '')"


def number(x: str) -> str:
    return f"CAST(CASE WHEN lower(trim({x}, ' ')) NOT IN {WORDS} THEN trim({x}, ' ') END AS DECIMAL(18,4))"


def sentinel_day(x: str) -> str:
    return f"CAST(CASE WHEN lower(trim({x}, ' ')) NOT IN {DATE_WORDS} THEN trim({x}, ' ') END AS DATE)"


def usable(x: str) -> str:
    return f"({x} IS NOT NULL AND lower(trim({x}, ' ')) NOT IN {WORDS})"


def newest(source: str, key, columns, order=("_ingested_at",)) -> str:
    rest = [c for c in columns if c not in key and c not in order]
    by = ", ".join(f"{c} DESC NULLS FIRST" for c in (*order, *rest))
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {by}) = 1"


def doubles(source: str, *columns: str, extra: str = "", where: str = "", tail: str = "") -> str:
    """All columns of a subquery, the named decimals as doubles."""
    swapped = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    star = f"* REPLACE ({swapped})" if columns else "*"
    return f"SELECT {star}{extra} FROM {source} {where} {tail}"


LINEAGE = ["_source_file", "_source_platform", "_ingested_at", "_batch_id"]

# --- subqueries by name ---------------------------------------------------------

CTE: dict[str, str] = {}

CTE["places"] = "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"
CTE["lines"] = f"""SELECT *, CAST(o_orderdate AS DATE) + 9862 AS day, {money('l_extendedprice')} AS gross,
    {money('l_quantity')} AS qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTE["buyers"] = "SELECT * FROM customer LEFT JOIN places ON c_nationkey = n_nationkey"

CTE["raw_sales_transactions"] = f"""
    SELECT {varchar('l_orderkey')} AS order_id, {varchar('day')} AS order_date, {varchar('month(day)')} AS order_month,
        'Q' || quarter(day) AS order_quarter, {varchar('year(day)')} AS order_year, {varchar('o_custkey')} AS customer_id,
        r_name AS region, n_name AS province, CASE WHEN o_orderkey % 211 = 0 THEN ' ' ELSE c_mktsegment END AS channel,
        CASE WHEN o_orderkey % 503 = 0 THEN '' ELSE {emp('o_custkey // 20')} END AS employee_id,
        {varchar('l_partkey')} AS product_id, p_type AS product_category, {varchar('qty')} AS quantity,
        {ratio_text('gross', 'qty')} AS unit_price, {varchar(money('l_discount') + ' * 100')} AS discount_pct,
        {varchar('rebate')} AS discount_amount, {varchar('gross')} AS gross_amount,
        {varchar('gross - rebate')} AS net_amount, l_linestatus AS delivery_status, o_orderpriority AS payment_method,
        o_orderstatus AS payment_status, {lineage('01_sales_transactions', minutes='l_linenumber')}
    FROM (SELECT *, CAST(round(gross * {money('l_discount')}, 2) AS DECIMAL(18,2)) AS rebate FROM lines)
    LEFT JOIN buyers ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey"""

CTE["raw_distributor_orders"] = f"""
    SELECT {varchar('l_orderkey')} AS order_id, {varchar('day')} AS order_date, {varchar('month(day)')} AS order_month,
        'Q' || quarter(day) AS order_quarter, {varchar('l_suppkey')} AS distributor_id, r_name AS region,
        c_mktsegment AS channel, {varchar('l_partkey')} AS product_id, p_type AS product_category,
        {varchar('ordered')} AS qty_ordered, {varchar('delivered')} AS qty_delivered,
        {ratio_text('delivered', 'ordered', 100)} AS fill_rate_pct, {ratio_text('gross', 'qty')} AS unit_price_list,
        {varchar(money('p_retailprice'))} AS distributor_price, {varchar('gross')} AS gross_amount,
        {varchar('CAST(coalesce(' + ratio('gross * delivered', 'ordered', 2, 1) + ', 0) AS DECIMAL(18,2))')} AS delivered_amount,
        {varchar('day + 7 + l_linenumber')} AS expected_delivery_date,
        CASE WHEN NOT (l_linestatus = 'O' AND l_returnflag = 'N') THEN {varchar('day + CAST(5 + l_partkey % 10 AS INTEGER)')} END AS actual_delivery_date,
        l_returnflag AS ontime_delivery, CASE WHEN l_partkey % 50 <> 0 THEN l_linestatus END AS delivery_status,
        CASE WHEN batch = 1 THEN 'REVISED' ELSE o_orderpriority END AS payment_terms,
        {lineage('05_distributor_orders', 'batch', 'l_linenumber')}
    FROM (
        SELECT *, CAST(ordered - CASE WHEN l_returnflag = 'R' THEN ordered % 5 ELSE 0 END AS DECIMAL(18,2)) AS delivered
        FROM (SELECT *, CASE WHEN l_partkey % 211 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE qty END AS ordered
              FROM {twice('lines', 'l_orderkey % 50 = 0')})
    )
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN places ON s_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey"""

CTE["raw_return_transactions"] = f"""
    SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS return_id,
        {varchar('l_orderkey')} AS original_order_id, {varchar('back')} AS return_date, {varchar('month(back)')} AS return_month,
        {varchar('o_custkey')} AS customer_id, {emp('o_custkey // 20')} AS employee_id, {varchar('l_partkey')} AS product_id,
        r_name AS region, n_name AS province, {varchar('qty')} AS return_quantity, {ratio_text('gross', 'qty')} AS unit_price,
        {varchar('gross')} AS return_amount,
        CASE WHEN l_linestatus = 'F' THEN 'Damaged' ELSE 'Wrong item' END AS return_reason,
        CASE WHEN batch = 1 THEN 'Closed' ELSE 'Open' END AS status, {lineage('09_return_transactions', 'batch')}
    FROM (SELECT *, CAST(l_shipdate AS DATE) + 9862 AS back FROM {twice("(SELECT * FROM lines WHERE l_returnflag = 'R')", 'l_orderkey % 40 = 0')})
    LEFT JOIN buyers ON o_custkey = c_custkey"""

CTE["raw_customer_master"] = f"""
    SELECT CASE WHEN c_custkey % 97 = 0 THEN 'nan' WHEN c_custkey % 89 = 0 THEN '  ' || c_custkey || ' '
            ELSE {varchar('c_custkey')} END AS customer_id,
        c_name AS customer_name, CASE WHEN c_acctbal < 0 THEN 'Retail' ELSE 'Wholesale' END AS customer_type,
        c_mktsegment AS channel, n_name AS province, CASE WHEN c_custkey % 101 <> 0 THEN r_name END AS region,
        'Street ' || c_custkey AS address, {pad('c_custkey', 10)} AS phone,
        CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'TX' || c_custkey END AS tax_code,
        CASE WHEN c_custkey % 83 = 0 THEN '  ' ELSE 'Active' END AS status,
        {varchar("DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER)")} AS join_date,
        {varchar(money('c_acctbal') + ' * 25000 + batch * 1000000')} AS credit_limit,
        {lineage('03_customer_master', 'batch')}
    FROM {twice('buyers', 'c_custkey % 10 = 0')}"""

CTE["raw_product_master"] = f"""
    SELECT {varchar('p_partkey')} AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
        'PCS' AS unit, CASE WHEN p_partkey % 199 = 0 THEN '0' ELSE {varchar('price + batch')} END AS unit_price,
        CASE WHEN p_partkey % 97 <> 0 THEN {varchar('CAST(round(price * 0.6, 2) AS DECIMAL(18,2))')} END AS cost_price,
        {varchar('p_size * 100')} AS weight_gram, CASE WHEN p_size > 45 THEN 'Discontinued' ELSE 'Active' END AS status,
        {varchar("DATE '2019-01-01' + CAST(p_partkey % 700 AS INTEGER)")} AS launch_date,
        {lineage('04_product_master', 'batch')}
    FROM (SELECT *, {money('p_retailprice')} AS price FROM {twice('part', 'p_partkey % 20 = 0')})"""

CTE["raw_distributor_master"] = f"""
    SELECT {varchar('s_suppkey')} AS distributor_id, s_name AS distributor_name, 'Tier ' || (s_suppkey % 3 + 1) AS tier,
        CASE WHEN s_suppkey % 2 = 0 THEN 'General Trade' ELSE 'Modern Trade' END AS channel, n_name AS province,
        r_name AS region, 'Contact ' || s_suppkey AS contact_person, {pad('s_suppkey', 10)} AS phone,
        'd' || s_suppkey || '@example.com' AS email, 'TD' || s_suppkey AS tax_code,
        {varchar("DATE '2018-01-01' + CAST(s_suppkey % 900 AS INTEGER)")} AS join_date,
        CASE WHEN s_suppkey % 53 = 0 THEN 'nan' ELSE {varchar(money('s_acctbal') + ' * 60000')} END AS credit_limit,
        CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE 'Active' END AS status,
        {emp('s_suppkey // 20')} AS assigned_supervisor_id, {lineage('06_distributor_master')}
    FROM supplier LEFT JOIN places ON s_nationkey = n_nationkey"""

CTE["raw_employee_master"] = f"""
    SELECT CASE WHEN n % 37 = 5 THEN 'None' ELSE {emp('n')} END AS employee_id, 'Employee ' || n AS full_name, CASE WHEN n % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        {varchar("DATE '1980-01-01' + CAST(n % 7000 AS INTEGER)")} AS date_of_birth, '2021-06-01' AS join_date,
        'Level ' || v AS position, 'Region ' || ((n + v) % 5) AS region, 'Team ' || (n % 4) AS team,
        'e' || n || '@example.com' AS email, {pad('n', 10)} AS phone,
        CASE WHEN n % 5 = 0 THEN 'Resigned' ELSE 'Active' END AS status, 'v' || v AS version, since AS effective_date,
        CASE WHEN n % 5 = 0 THEN '2026-06-30' END AS resign_date, CASE WHEN v > 1 THEN 'transfer' ELSE '' END AS transfer_note,
        {lineage('07_employee_master')}
    FROM (SELECT DISTINCT c_custkey // 20 AS n FROM customer)
    JOIN (VALUES (1, '2022-01-01', 1), (2, '2024-01-01', 2), (3, '2025-07-01', 4)) AS steps(v, since, every) ON n % every = 0"""

CTE["raw_territory_mapping"] = f"""
    SELECT 'T' || {pad('c_nationkey', 2)} AS territory_id, {emp('c_custkey // 20')} AS employee_id,
        CASE WHEN c_custkey % 97 = 0 THEN 'None' ELSE {varchar('c_custkey')} END AS customer_id,
        'Region ' || (c_nationkey % 5) AS region, 'Team ' || (c_custkey % 4) AS team, '2022-01-01' AS effective_date,
        CASE WHEN c_custkey % 13 = 0 THEN '2025-12-31' END AS expiry_date, 'v1' AS version, {lineage('08_territory_mapping')}
    FROM customer"""

CTE["raw_promotion_program"] = f"""
    SELECT 'PR' || bundle AS promotion_id, 'Promotion ' || bundle AS promotion_name,
        CASE WHEN bundle % 2 = 0 THEN 'Discount' ELSE 'Bundle' END AS promotion_type, 'General Trade' AS target_channel,
        '' AS target_region, {varchar("DATE '2024-01-01' + CAST(bundle % 300 AS INTEGER)")} AS start_date,
        {varchar("DATE '2024-02-01' + CAST(bundle % 300 AS INTEGER)")} AS end_date, kind AS applicable_products,
        {varchar('bundle % 30')} AS discount_pct, {varchar('products')} AS min_order_quantity, {varchar('value')} AS budget_vnd,
        {varchar('CAST(round(CAST(value AS DECIMAL(18,2)) * 0.9, 2) AS DECIMAL(18,2))')} AS actual_cost_vnd,
        'Active' AS status, 'nan' AS created_by, {lineage('10_promotion_program')}
    FROM (SELECT p_partkey // 5 AS bundle, sum({money('p_retailprice')}) AS value, count(*) AS products, min(p_type) AS kind FROM part GROUP BY 1)"""

CTE["plan_sheets"] = f"""
    SELECT CASE WHEN second THEN 'Adjustment' ELSE 'Original' END AS plan_version,
        CASE WHEN second THEN '2024-06-20' ELSE '2023-12-15' END AS version_date, '2024-01-01' AS effective_from,
        CASE WHEN n % 7 = 0 THEN 'nan' ELSE '2024-12-31' END AS effective_to, {emp('n')} AS employee_id,
        'Employee ' || n AS employee_name, 'Region ' || (n % 5) AS region, 'Team ' || (n % 4) AS team, '2024' AS year,
        m || CASE WHEN n % 9 = 0 THEN '.0' ELSE '' END AS month,
        {varchar("CAST(CASE WHEN n % 11 = 7 THEN 0 ELSE (500000 + 10 * CAST(balance AS DECIMAL(18,2))) * CASE WHEN second THEN 1.1 ELSE 1.0 END END AS DECIMAL(18,3))")} AS target_revenue,
        {varchar('50 + customers')} AS target_quantity, {varchar('customers')} AS target_new_customers, sheet_name
    FROM (
        SELECT c_custkey // 20 AS n, 1 + c_custkey % 12 AS m, sum({money('c_acctbal')}) AS balance, count(*) AS customers
        FROM customer GROUP BY 1, 2
    )
    JOIN (VALUES ('Plan_v1_Original', 1, false), ('Plan_v2_Adjustment_H2', 7, true), ('summary', 1, false))
        AS sheets(sheet_name, since, second) ON m >= since
    UNION ALL
    SELECT CASE WHEN r_regionkey > 0 THEN 'Original' END, NULL, NULL, NULL,
        CASE WHEN r_regionkey = 1 THEN 'Grand Total' WHEN r_regionkey > 1 THEN 'E001' END,
        CASE WHEN r_regionkey = 2 THEN 'TỔNG CỘNG' END, NULL, NULL, CASE WHEN r_regionkey > 0 THEN '2024' END,
        CASE WHEN r_regionkey = 3 THEN '13' WHEN r_regionkey = 4 THEN 'abc' WHEN r_regionkey > 0 THEN '1' END,
        CASE WHEN r_regionkey > 0 THEN '1.000' END, NULL, NULL, noisy.sheet_name
    FROM region JOIN (VALUES ('Plan_v1_Original'), ('Plan_v2_Adjustment_H2')) AS noisy(sheet_name) ON true"""

CTE["raw_sales_target_plan"] = f"""
    SELECT * EXCLUDE (sheet_name), {lineage('02_sales_target_plan')} FROM plan_sheets WHERE sheet_name = 'Plan_v1_Original'"""


def plan_table(source: str, file_name: str) -> str:
    """Plan sheets without blank, total and month-less rows, in the plan table's columns."""
    own = [c for c in PLAN_COLUMNS if c not in ("version_label", "month_col", *LINEAGE)]
    return f"""
    SELECT regexp_extract(lower(sheet_name), 'v[0-9]+') AS version_label, 'T' || token AS month_col, {', '.join(own)},
        '{file_name}' AS _source_file, 'tables' AS _source_platform, TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at,
        'batch-1' AS _batch_id
    FROM (SELECT *, CASE WHEN TRY_CAST(month AS DOUBLE) = floor(TRY_CAST(month AS DOUBLE)) THEN CAST(TRY_CAST(month AS DOUBLE) AS INTEGER) END AS token FROM {source})
    WHERE token BETWEEN 1 AND 12 AND NOT coalesce(regexp_matches(lower(employee_id), 'tổng|total'), false)
        AND NOT coalesce(regexp_matches(lower(employee_name), 'tổng|total'), false)"""


CTE["raw_sales_targets_raw"] = plan_table("(SELECT * FROM plan_sheets WHERE sheet_name <> 'summary')", "SRC02_sales_target_plan")


def _silver(table: str) -> None:
    spec = TYPED[table]
    kinds = {"text": clean, "num": number, "date": lambda x: f"CAST({clean(x)} AS DATE)", "int": lambda x: f"CAST({clean(x)} AS INTEGER)"}
    picked = ", ".join(f"{kinds[k]('r.' + spec.renamed.get(c, c))} AS {c}" for c, k in spec.columns.items())
    source = spec.source
    valid = " AND ".join(usable(f"r.{k}") for k in spec.required)
    typed = f"(SELECT {picked}, {', '.join(LINEAGE)} FROM {source} AS r WHERE {valid})"
    CTE[table] = newest(typed, spec.key, [*spec.columns, *LINEAGE])


for _table in TYPED:
    _silver(_table)

_TARGET_COLUMNS = (
    "version_label version_rank version_date effective_from effective_to employee_id employee_name region team "
    "target_year target_month month_col target_month_date target_revenue target_quantity target_new_customers sheet_name"
).split()
CTE["typed_targets"] = f"""
    SELECT {clean('version_label')} AS version_label,
        TRY_CAST(regexp_extract(lower(trim(version_label, ' ')), '^v([0-9]+)$', 1) AS INTEGER) AS version_rank,
        {', '.join(f'{sentinel_day(c)} AS {c}' for c in ('version_date', 'effective_from', 'effective_to'))},
        {', '.join(f'{clean(c)} AS {c}' for c in ('employee_id', 'employee_name', 'region', 'team', 'month_col', 'sheet_name'))},
        CAST(round({number('year')}) AS INTEGER) AS target_year, CAST(round({number('month')}) AS INTEGER) AS target_month,
        make_date(CAST(round({number('year')}) AS INTEGER), CAST(round({number('month')}) AS INTEGER), 1) AS target_month_date,
        {', '.join(f'{number(c)} AS {c}' for c in ('target_revenue', 'target_quantity', 'target_new_customers'))},
        {', '.join(LINEAGE)}
    FROM raw_sales_targets_raw
    WHERE {usable('version_label')} AND {usable('employee_id')} AND regexp_matches(month_col, '^T([1-9]|1[0-2])$')"""
CTE["newest_targets"] = newest(
    "typed_targets", ("version_label", "employee_id", "target_year", "month_col"), [*_TARGET_COLUMNS, *LINEAGE]
)
CTE["stg_sales_targets_versioned"] = """
    SELECT *, row_number() OVER (PARTITION BY employee_id, target_year, target_month
        ORDER BY version_rank DESC NULLS FIRST, version_date DESC NULLS FIRST, _ingested_at DESC NULLS FIRST,
            version_label DESC, month_col DESC) = 1 AS is_latest
    FROM newest_targets"""

# --- gold -----------------------------------------------------------------------

CTE["dim_date"] = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date_day, CAST(year(d) AS INTEGER) AS calendar_year,
        CAST(quarter(d) AS INTEGER) AS calendar_quarter, CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
        CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(year(d) - CASE WHEN month(d) < 9 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
        CAST(((month(d) + 3) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(DATE '2022-01-01', DATE '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"""


def credit(high: int, medium: int, x: str = "credit_limit") -> str:
    return f"""CASE WHEN {x} IS NULL THEN 'Unknown' WHEN {x} >= {high} THEN 'High Credit'
        WHEN {x} >= {medium} THEN 'Medium Credit' ELSE 'Low Credit' END"""


CTE["dim_customers"] = f"SELECT customer_id AS customer_key, *, {credit(200000000, 100000000)} AS credit_limit_tier FROM stg_customers"
CTE["dim_distributors"] = f"SELECT distributor_id AS distributor_key, *, {credit(500000000, 200000000)} AS credit_limit_tier FROM stg_distributors"
CTE["dim_products"] = f"""SELECT product_id AS product_key, *, unit_price - cost_price AS unit_margin,
    {ratio('unit_price - cost_price', 'unit_price')} AS unit_margin_pct FROM stg_products"""
CTE["dim_employees"] = """
    SELECT employee_id || '_' || strftime(effective_date, '%Y%m%d') AS employee_key, * EXCLUDE (effective_date, successor),
        effective_date AS effective_from,
        coalesce(successor - 1, resign_date, DATE '9999-12-31') AS effective_to, successor IS NULL AS is_current
    FROM (SELECT *, lead(effective_date) OVER (PARTITION BY employee_id ORDER BY effective_date NULLS LAST) AS successor FROM stg_employees)"""
CTE["dim_regions"] = """SELECT row_number() OVER (ORDER BY region) AS region_key, region
    FROM (SELECT DISTINCT coalesce(region, 'Unknown') AS region FROM dim_customers)"""
CTE["dim_geography"] = """SELECT row_number() OVER (ORDER BY region, province) AS geography_key,
        dense_rank() OVER (ORDER BY region) AS region_key, region, province
    FROM (SELECT DISTINCT coalesce(region, 'Unknown') AS region, coalesce(province, 'Unknown') AS province FROM dim_customers)"""
CTE["dim_channels"] = """SELECT row_number() OVER (ORDER BY channel) AS channel_key, channel
    FROM (SELECT DISTINCT coalesce(channel, 'Unknown') AS channel FROM stg_sales_transactions)"""
CTE["fact_sales"] = f"""
    SELECT s.*, d.date_key AS order_date_key, c.customer_key, p.product_key, e.employee_key,
        s.quantity * p.cost_price AS total_cost, s.net_amount - s.quantity * p.cost_price AS gross_profit,
        {ratio('s.net_amount - s.quantity * p.cost_price', 's.net_amount')} AS gross_profit_margin_pct
    FROM stg_sales_transactions AS s
    LEFT JOIN dim_date AS d ON d.date_day = s.order_date
    LEFT JOIN dim_customers AS c ON c.customer_id = s.customer_id
    LEFT JOIN dim_products AS p ON p.product_id = s.product_id
    LEFT JOIN dim_employees AS e ON e.employee_id = s.employee_id AND s.order_date >= e.effective_from AND s.order_date <= e.effective_to"""
CTE["fact_returns"] = """
    SELECT r.*, d.date_key AS return_date_key, c.customer_key, p.product_key, e.employee_key,
        r.return_quantity * p.cost_price AS return_cost_amount,
        r.return_amount - r.return_quantity * p.cost_price AS return_margin_impact
    FROM stg_return_transactions AS r
    LEFT JOIN dim_date AS d ON d.date_day = r.return_date
    LEFT JOIN dim_customers AS c ON c.customer_id = r.customer_id
    LEFT JOIN dim_products AS p ON p.product_id = r.product_id
    LEFT JOIN dim_employees AS e ON e.employee_id = r.employee_id AND r.return_date >= e.effective_from AND r.return_date <= e.effective_to"""
CTE["fact_targets"] = """
    SELECT t.* EXCLUDE (sheet_name), d.date_key AS target_date_key, e.employee_key
    FROM stg_sales_targets_versioned AS t
    LEFT JOIN dim_date AS d ON d.date_day = t.target_month_date
    LEFT JOIN dim_employees AS e ON e.employee_id = t.employee_id
        AND t.target_month_date >= e.effective_from AND t.target_month_date <= e.effective_to
    WHERE t.is_latest"""
CTE["fact_distributor_orders"] = f"""
    SELECT o.*, d1.date_key AS order_date_key, d2.date_key AS expected_delivery_date_key, d3.date_key AS actual_delivery_date_key,
        x.distributor_key, p.product_key, {ratio('o.qty_delivered', 'o.qty_ordered')} AS calculated_fill_rate_pct,
        o.actual_delivery_date <= o.expected_delivery_date AS calculated_on_time_delivery
    FROM stg_distributor_orders AS o
    LEFT JOIN dim_date AS d1 ON d1.date_day = o.order_date
    LEFT JOIN dim_date AS d2 ON d2.date_day = o.expected_delivery_date
    LEFT JOIN dim_date AS d3 ON d3.date_day = o.actual_delivery_date
    LEFT JOIN dim_distributors AS x ON x.distributor_id = o.distributor_id
    LEFT JOIN dim_products AS p ON p.product_id = o.product_id"""
CTE["actuals"] = """
    SELECT employee_id, CAST(date_trunc('month', order_date) AS DATE) AS sales_month_date,
        count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS active_customers,
        sum(quantity) AS actual_quantity, sum(gross_amount) AS actual_gross_amount, sum(discount_amount) AS actual_discount_amount,
        sum(net_amount) AS actual_revenue, sum(total_cost) AS actual_total_cost, sum(gross_profit) AS actual_gross_profit
    FROM fact_sales GROUP BY 1, 2"""
CTE["mart_sales_vs_target"] = f"""
    SELECT coalesce(t.employee_id, a.employee_id) AS employee_id, t.employee_name,
        coalesce(t.target_month_date, a.sales_month_date) AS month_date,
        CAST(coalesce(t.target_year, year(a.sales_month_date)) AS INTEGER) AS year,
        CAST(coalesce(t.target_month, month(a.sales_month_date)) AS INTEGER) AS month, t.region, t.team, t.version_label,
        coalesce(total_orders, 0) AS total_orders, coalesce(active_customers, 0) AS active_customers,
        coalesce(actual_quantity, 0) AS actual_quantity, coalesce(target_quantity, 0) AS target_quantity,
        coalesce(actual_quantity, 0) - coalesce(target_quantity, 0) AS quantity_gap,
        {ratio('coalesce(actual_quantity, 0)', 'target_quantity')} AS quantity_achievement_pct,
        coalesce(actual_revenue, 0) AS actual_revenue, coalesce(target_revenue, 0) AS target_revenue,
        coalesce(actual_revenue, 0) - coalesce(target_revenue, 0) AS revenue_gap,
        {ratio('coalesce(actual_revenue, 0)', 'target_revenue')} AS revenue_achievement_pct,
        coalesce(actual_total_cost, 0) AS actual_total_cost, coalesce(actual_gross_profit, 0) AS actual_gross_profit,
        {ratio('actual_gross_profit', 'actual_revenue')} AS actual_gross_profit_margin_pct,
        coalesce(target_new_customers, 0) AS target_new_customers
    FROM fact_targets AS t FULL JOIN actuals AS a ON a.employee_id = t.employee_id AND a.sales_month_date = t.target_month_date"""
CTE["distributor_months"] = """
    SELECT f.distributor_id, d.distributor_name, d.tier, d.channel AS distributor_channel, d.province, d.region AS distributor_region,
        CAST(date_trunc('month', f.order_date) AS DATE) AS month_date, f.region AS order_region, f.channel AS order_channel,
        count(DISTINCT f.order_id) AS total_orders, count(DISTINCT f.product_id) AS products_ordered,
        sum(f.qty_ordered) AS total_qty_ordered, sum(f.qty_delivered) AS total_qty_delivered,
        sum(f.gross_amount) AS total_gross_amount, sum(f.delivered_amount) AS total_delivered_amount,
        count(*) FILTER (WHERE f.calculated_on_time_delivery) AS on_time_delivery_count,
        count(*) FILTER (WHERE NOT f.calculated_on_time_delivery) AS late_delivery_count,
        count(f.delivery_status) AS delivery_record_count, count(*) AS order_record_count
    FROM fact_distributor_orders AS f LEFT JOIN dim_distributors AS d ON d.distributor_id = f.distributor_id GROUP BY ALL"""
CTE["mart_distributor_performance"] = f"""
    SELECT *, CAST(year(month_date) AS INTEGER) AS year, CAST(month(month_date) AS INTEGER) AS month,
        {ratio('total_qty_delivered', 'total_qty_ordered')} AS fill_rate_pct,
        {ratio('total_delivered_amount', 'total_gross_amount')} AS delivered_amount_rate_pct,
        {ratio('on_time_delivery_count', 'delivery_record_count')} AS on_time_delivery_rate_pct
    FROM distributor_months"""

# --- statements by query key -------------------------------------------------------

SQL: dict[str, str] = {}

_sales = ", ".join(SOURCES["sales_transactions"].columns)
SQL["src_csv_roundtrip"] = f"SELECT * REPLACE (NULLIF(employee_id, '') AS employee_id) FROM (SELECT {_sales} FROM raw_sales_transactions)"
SQL["src_sheet_select"] = "SELECT * FROM plan_sheets WHERE sheet_name = 'Plan_v2_Adjustment_H2'"
SQL["src_sheet_position"] = "SELECT * EXCLUDE (sheet_name) FROM plan_sheets WHERE sheet_name = 'Plan_v2_Adjustment_H2'"
SQL["src_sheets_skip"] = "SELECT * FROM plan_sheets WHERE sheet_name <> 'summary'"
SQL["src_dispatch"] = """SELECT 'SRC03_customer_master.csv' AS source, count(*) AS row_count FROM raw_customer_master
    UNION ALL SELECT 'SRC04_product_master.PARQUET', count(*) FROM raw_product_master
    UNION ALL SELECT 'SRC02_sales_target_plan.sheets', count(*) FROM plan_sheets WHERE sheet_name = 'Plan_v1_Original'"""
SQL["date_spine"] = """
    SELECT date_day, count(o_orderkey) AS orders
    FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders)
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_day GROUP BY date_day"""
SQL["bronze_row_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM raw_{t}" for t in SOURCES)
_loads = [
    ("sales_transactions", "SRC01_sales_transactions.csv", "(SELECT CAST(count(*) AS INTEGER) FROM raw_sales_transactions)", "SUCCESS"),
    ("customer_master", "SRC03_customer_master.csv", "(SELECT CAST(count(*) AS INTEGER) FROM raw_customer_master)", "SUCCESS"),
    ("product_master", "SRC04_product_master.csv", "0", "FAILED"),
]
SQL["ingest_log_latest"] = " UNION ALL ".join(
    f"SELECT '{t}' AS source_name, '{f}' AS source_file, CAST({n} AS INTEGER) AS rows_loaded, '{s}' AS status" for t, f, n, s in _loads
)
SQL["ingest_log_rows"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS source_name, '{f}' AS source_file, 'local' AS source_platform, CAST({n} AS INTEGER) AS rows_loaded,
    '{s}' AS status, {str(s == 'FAILED').lower()} AS has_message, true AS finished_after_start, true AS has_duration, true AS has_batch_id"""
    for t, f, n, s in _loads
)
_headers = {t: ", ".join(SOURCES[t].columns) for t in SOURCES}
SQL["source_inventory"] = f"""
    SELECT 'SRC01_sales_transactions.csv' AS source_file, 'OK' AS status, count(*) AS row_count, '{_sales}' AS columns FROM raw_sales_transactions
    UNION ALL SELECT 'SRC03_customer_master.csv', 'OK', count(*), '{_headers['customer_master']}' FROM raw_customer_master
    UNION ALL SELECT 'SRC04_product_master.PARQUET', 'OK', count(*), '{_headers['product_master']}' FROM raw_product_master
    UNION ALL SELECT 'SRC02_sales_target_plan.sheets', 'OK', count(*), '{_headers['sales_target_plan']}' FROM raw_sales_target_plan
    UNION ALL SELECT 'notes.txt', 'FAILED', NULL, NULL"""
SQL["bronze_load_sales"] = f"""
    SELECT {_sales}, 'SRC01_sales_transactions.csv' AS _source_file, 'local' AS _source_platform
    FROM (SELECT * REPLACE (NULLIF(employee_id, '') AS employee_id) FROM raw_sales_transactions)"""


def cells(table: str) -> str:
    texts = ", ".join(f"CASE WHEN {c} IN {MISSING} THEN '<null>' ELSE coalesce({c}, '<null>') END" for c in SOURCES[table].columns)
    source = SOURCES[table]
    suffix = ".sheets" if source.sheets else ".csv"
    return f"SELECT '{table}' AS table_name, '{source.file}{suffix}' AS _source_file, concat_ws('|', {texts}) AS cells FROM raw_{table}"


SQL["bronze_load_all"] = f"SELECT *, count(*) AS n FROM ({' UNION ALL '.join(cells(t) for t in SOURCES)}) GROUP BY ALL"
SQL["bronze_retry_once"] = f"SELECT table_name, 'load-1' AS _batch_id, cells, count(*) AS n FROM ({cells('customer_master')}) GROUP BY ALL"
SQL["silver_incremental"] = doubles(
    """(SELECT * FROM stg_customers UNION ALL SELECT * REPLACE ('L' || customer_id AS customer_id,
        TIMESTAMP '2023-12-31 00:00:00' AS _ingested_at, 'batch-0' AS _batch_id) FROM stg_customers WHERE _batch_id = 'batch-2')""", "credit_limit")
SQL["target_sheets_aligned"] = """
    SELECT sheet_name, version_label, employee_id, month_col, target_revenue, CASE WHEN version_label = 'v2' THEN target_quantity END AS target_quantity
    FROM raw_sales_targets_raw WHERE version_label IN ('v1', 'v2')"""
SQL["bronze_append_twice"] = """
    SELECT 'bronze' AS table_name, 2 * count(*) AS row_count FROM raw_product_master
    UNION ALL SELECT 'newest', count(*) FROM part UNION ALL SELECT 'second batch', count(*) FROM part"""
SQL["materialize_overwrite"] = "SELECT product_id, category, CAST(unit_price * 2 AS DOUBLE) AS unit_price, status FROM stg_products"
CTE["normalised_plan"] = plan_table("(SELECT * REPLACE (replace(sheet_name, 'summary', 'Plan_v3_summary') AS sheet_name) FROM plan_sheets)", "SRC02")
SQL["replace_slice"] = """
    SELECT sheet_name, CASE WHEN version_label = 'v1' THEN 'batch-2' ELSE 'batch-1' END AS _batch_id, employee_id, month_col, target_revenue
    FROM normalised_plan WHERE (version_label = 'v1' AND month_col < 'T5') OR version_label = 'v2'"""
SQL["target_file_log"] = """
    SELECT 'SRC02_sales_target_plan.sheets' AS source_file, p.sheet_name, regexp_extract(lower(p.sheet_name), 'v[0-9]+') AS version_label,
        CAST(count(r.month) AS INTEGER) AS rows_loaded, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message
    FROM (SELECT DISTINCT sheet_name FROM plan_sheets WHERE sheet_name <> 'summary') AS p
    LEFT JOIN raw_sales_targets_raw AS r ON r.sheet_name = p.sheet_name GROUP BY p.sheet_name
    UNION ALL SELECT 'SRC02_sales_target_plan.sheets', 'Draft', NULL, 0, 'FAILED', 'no version label in sheet name: Draft'"""
SQL["target_versions_load"] = """
    SELECT * EXCLUDE (_ingested_at, _batch_id) REPLACE ('SRC02_sales_target_plan.sheets' AS _source_file, 'local' AS _source_platform,
        NULLIF(effective_to, 'nan') AS effective_to) FROM raw_sales_targets_raw"""
SQL["target_version_summary"] = """
    SELECT version_label, min(_source_file) AS source_file, min(sheet_name) AS sheet_name, count(*) AS row_count,
        count(DISTINCT employee_id) AS employee_count, count(DISTINCT month_col) AS month_count, min(month_col) AS min_month_col,
        max(month_col) AS max_month_col, min(_ingested_at) AS first_ingested_at, max(_ingested_at) AS last_ingested_at
    FROM raw_sales_targets_raw GROUP BY version_label"""

SQL["brz_normalize_columns"] = "SELECT p_partkey AS part_key, p_brand AS brand_name, p_size AS size FROM part"
SQL["brz_lineage"] = """SELECT o_orderkey, o_orderstatus, 'orders.csv' AS _source_file, 'tables' AS _source_platform,
    TIMESTAMP '2024-01-01 12:30:00' AS _ingested_at, 'batch-1' AS _batch_id FROM orders"""
SQL["brz_all_string"] = f"""SELECT {', '.join(f'{varchar(c)} AS {c}' for c in ('o_orderkey', 'o_custkey', 'c_custkey', 'c_nationkey', 'c_mktsegment'))},
    {varchar('CAST(o_orderdate AS DATE)')} AS o_day, 'f' AS _source_file, 'tables' AS _source_platform,
    TIMESTAMP '2024-01-01 00:00:00' AS _ingested_at, 'batch-1' AS _batch_id FROM orders JOIN customer ON o_custkey = c_custkey"""
SQL["brz_drop_empty"] = """
    SELECT flag, status, line, count(*) AS n FROM (
        SELECT CASE WHEN l_partkey % 3 <> 0 THEN l_returnflag END AS flag, CASE WHEN l_suppkey % 2 <> 0 THEN l_linestatus END AS status,
            CASE WHEN l_orderkey % 5 = 0 THEN l_linenumber END AS line FROM lineitem)
    WHERE coalesce(flag, status, CAST(line AS VARCHAR)) IS NOT NULL GROUP BY flag, status, line"""
SQL["brz_align"] = "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS target_quantity, CAST(NULL AS VARCHAR) AS target_new_customers) FROM plan_sheets"
SQL["brz_drop_totals"] = f"""
    SELECT {varchar('o_orderkey')} AS employee_id, CASE WHEN o_custkey % 6 > 2 THEN 'An' END AS employee_name, '3' AS month
    FROM orders WHERE o_custkey % 6 NOT IN (0, 1) AND o_orderkey % 7 <> 0"""
SQL["brz_version_label"] = "SELECT 'v' || l_linenumber AS label, count(*) AS n FROM lineitem GROUP BY l_linenumber"
SQL["brz_month_token"] = """
    SELECT month, CASE WHEN whole BETWEEN 1 AND 12 THEN 'T' || whole END AS token, count(*) AS n FROM (
        SELECT CASE WHEN l_partkey % 17 = 0 THEN 'abc' WHEN l_partkey % 19 <> 0 THEN (l_partkey % 15) || CASE WHEN l_orderkey % 2 = 0 THEN '.7' ELSE '' END END AS month,
            CASE WHEN l_partkey % 17 <> 0 AND l_partkey % 19 <> 0 AND l_orderkey % 2 <> 0 THEN l_partkey % 15 END AS whole FROM lineitem)
    GROUP BY 1, 2"""
SQL["target_load_report"] = """
    SELECT 'rows per version' AS item, version_label AS member, count(*) AS value FROM raw_sales_targets_raw GROUP BY version_label
    UNION ALL SELECT 'rows per month', month_col, count(*) FROM raw_sales_targets_raw GROUP BY month_col
    UNION ALL SELECT 'total rows', NULL, count(*) FROM raw_sales_targets_raw WHERE lower(employee_id) LIKE '%tổng%'
        OR lower(employee_name) LIKE '%tổng%' OR lower(month_col) LIKE '%tổng%' OR lower(month_col) LIKE '%total%'"""
SQL["normalize_plan"] = "SELECT * FROM raw_sales_targets_raw"

SQL["slv_clean_text"] = f"SELECT address, {', '.join(f'{clean(c)} AS {c}' for c in ('customer_id', 'tax_code', 'status', 'region'))} FROM raw_customer_master"
SQL["slv_cast_date"] = f"SELECT {varchar('l_orderkey')} AS order_id, {varchar('l_partkey')} AS product_id, day AS order_date FROM lines"
SQL["slv_cast_numeric"] = "SELECT order_id, distributor_id, product_id, " + ", ".join(
    f"CAST({number(c)} AS DOUBLE) AS {c}" for c in ("qty_ordered", "qty_delivered", "fill_rate_pct", "delivered_amount")
) + " FROM raw_distributor_orders"
SQL["slv_cast_int"] = f"""SELECT {varchar('l_orderkey')} AS order_id, {varchar('l_partkey')} AS product_id,
    CAST(month(day) AS INTEGER) AS order_month, CAST(year(day) AS INTEGER) AS order_year FROM lines"""
SQL["slv_num_to_int"] = """SELECT order_id, product_id, CAST(round(CAST(unit_price AS DECIMAL(18,2))) AS INTEGER) AS unit_price,
    CAST(CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN -1 ELSE 1 END * (CAST(product_id AS BIGINT) + 1) AS INTEGER) AS half
    FROM raw_sales_transactions"""
SQL["slv_sentinel_date"] = f"""SELECT {varchar('l_orderkey')} AS order_id, {varchar('l_partkey')} AS product_id,
    CASE WHEN l_orderkey % 5 > 2 THEN day END AS day FROM lines"""
SQL["slv_version_rank"] = """
    SELECT kind || month(day) AS label, CASE WHEN lower(kind) = 'v' THEN CAST(month(day) AS INTEGER) END AS rank, count(*) AS n
    FROM (SELECT day, CASE l_orderkey % 4 WHEN 0 THEN 'v' WHEN 1 THEN 'V' WHEN 2 THEN 'xv' ELSE 'v-' END AS kind FROM lines) GROUP BY 1, 2"""
SQL["slv_make_date"] = "SELECT CAST(date_trunc('month', day) AS DATE) AS month_date, count(*) AS n FROM lines GROUP BY 1"
SQL["slv_valid_keys"] = f"SELECT territory_id, employee_id, customer_id FROM raw_territory_mapping WHERE {usable('customer_id')}"
SQL["slv_month_regex"] = """
    SELECT 'T' || token AS month_col, count(*) AS n
    FROM (SELECT month(day) + CASE WHEN l_orderkey % 4 = 0 THEN 1 ELSE 0 END AS token FROM lines WHERE l_orderkey % 9 <> 0)
    WHERE token <= 12 GROUP BY token"""

for _table, _spec in TYPED.items():
    SQL[_table] = doubles(_table, *[c for c, k in _spec.columns.items() if k == "num"])
SQL["stg_targets_versioned"] = doubles("stg_sales_targets_versioned", "target_revenue", "target_quantity", "target_new_customers")

SQL["dim_date"] = """SELECT d.*, coalesce(n, 0) AS sales_lines FROM dim_date AS d
    LEFT JOIN (SELECT order_date, count(*) AS n FROM stg_sales_transactions GROUP BY order_date) ON order_date = date_day"""
SQL["dim_customers"] = doubles("dim_customers", "credit_limit")
SQL["dim_products"] = doubles("dim_products", "unit_price", "cost_price", "weight_gram", "unit_margin")
SQL["dim_distributors"] = doubles("dim_distributors", "credit_limit")
for _table in ("dim_employees", "dim_regions", "dim_geography", "dim_channels"):
    SQL[_table] = f"SELECT * FROM {_table}"
_PLACE = ("region", "province", "channel")


def numbers(column: str, key: str, *near: str) -> str:
    least = ", ".join(f"min({c}) AS {c}" for c in near)
    order = ", ".join(f"{c} NULLS FIRST" for c in near)
    return f"""SELECT {column}, row_number() OVER (ORDER BY {order}, {column}) AS {key} FROM (
        SELECT {column}, {least} FROM (SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS month_date FROM stg_sales_transactions)
        WHERE {column} IS NOT NULL GROUP BY {column})"""


CTE["key_customers"] = numbers("customer_id", "customer_no", *_PLACE)
CTE["key_orders"] = numbers("order_id", "order_no", "month_date", *_PLACE)
SQL["key_customers"] = "SELECT * FROM key_customers"
SQL["key_orders"] = "SELECT * FROM key_orders"


def bits_of(kind: str, number: str, sums: bool) -> str:
    total = ", ".join(f"CAST({f'sum({c})' if sums else 'NULL'} AS DOUBLE) AS {n}" for c, n in (("net_amount", "revenue"), ("gross_profit", "gross_profit"), ("quantity", "units_sold")))
    return f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_date, region, province, channel, '{kind}' AS counted,
        ({number} - 1) // 32768 + 1 AS bucket, {total}, count(DISTINCT {number}) AS members
        FROM fact_sales LEFT JOIN key_customers USING (customer_id) LEFT JOIN key_orders USING (order_id) GROUP BY 1, 2, 3, 4, 5, 6"""


SQL["mart_sales_activity"] = bits_of("customers", "customer_no", True) + " UNION ALL " + bits_of("orders", "order_no", False)
SQL["fact_sales"] = doubles(
    "fact_sales", "quantity", "unit_price", "discount_pct", "discount_amount", "gross_amount", "net_amount", "total_cost", "gross_profit"
)
SQL["fact_returns"] = doubles("fact_returns", "return_quantity", "unit_price", "return_amount", "return_cost_amount", "return_margin_impact")
SQL["fact_targets"] = doubles("fact_targets", "target_revenue", "target_quantity", "target_new_customers")
SQL["fact_distributor_orders"] = doubles(
    "fact_distributor_orders", "qty_ordered", "qty_delivered", "fill_rate_pct", "unit_price_list", "distributor_price", "gross_amount",
    "delivered_amount",
)
_MART_SALES = (
    "actual_quantity", "target_quantity", "quantity_gap", "actual_revenue", "target_revenue", "revenue_gap", "actual_total_cost",
    "actual_gross_profit", "target_new_customers",
)
SQL["mart_sales_vs_target"] = doubles("mart_sales_vs_target", *_MART_SALES)
_MART_ORDERS = ("total_qty_ordered", "total_qty_delivered", "total_gross_amount", "total_delivered_amount")
SQL["mart_distributor_performance"] = doubles("mart_distributor_performance", *_MART_ORDERS)

SQL["join_dim_lookup"] = """SELECT s.order_id, s.product_id, s.customer_id, CAST(s.quantity AS DOUBLE) AS quantity, c.customer_key,
    CAST(p.cost_price AS DOUBLE) AS cost_price FROM stg_sales_transactions AS s
    LEFT JOIN stg_products AS p ON p.product_id = s.product_id
    LEFT JOIN (SELECT customer_id, customer_id AS customer_key FROM stg_customers) AS c ON c.customer_id = s.customer_id"""
_DAY_KEY = "CASE WHEN {0} BETWEEN DATE '2022-01-01' AND DATE '2026-12-31' THEN CAST(strftime({0}, '%Y%m%d') AS INTEGER) END AS {0}_key"
_ROLES = ("order_date", "expected_delivery_date", "actual_delivery_date")
SQL["join_role_dates"] = f"SELECT order_id, distributor_id, product_id, {', '.join(_ROLES)}, {', '.join(_DAY_KEY.format(r) for r in _ROLES)} FROM stg_distributor_orders"
SQL["join_scd_asof"] = """SELECT order_id, product_id, employee_id, order_date, (
        SELECT max(employee_key) FROM dim_employees AS e
        WHERE e.employee_id = s.employee_id AND s.order_date BETWEEN e.effective_from AND e.effective_to) AS employee_key
    FROM stg_sales_transactions AS s"""
CTE["event_versions"] = """
    SELECT user_id, event_type, day AS effective_from,
        coalesce(lead(day) OVER (PARTITION BY user_id ORDER BY day) - 1, DATE '9999-12-31') AS effective_to,
        lead(day) OVER (PARTITION BY user_id ORDER BY day) IS NULL AS is_current
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)"""
SQL["scd2_intervals"] = "SELECT * FROM event_versions"
SQL["join_scd_asof_bucketed"] = """
    SELECT event_id, e.user_id, CAST(ts AS DATE) - 1 AS day_before, v.event_type AS previous_type
    FROM events AS e ASOF LEFT JOIN event_versions AS v ON v.user_id = e.user_id AND CAST(e.ts AS DATE) - 1 >= v.effective_from"""
SQL["join_scd_asof_merge"] = """
    SELECT event_id, e.user_id, day_before, v.event_type AS previous_type
    FROM (SELECT event_id, user_id, CAST(CAST(ts AS DATE) - 1 + CASE WHEN event_id % 9 = 0 THEN INTERVAL 1000 YEARS ELSE INTERVAL 0 DAYS END AS DATE) AS day_before
          FROM events) AS e ASOF LEFT JOIN event_versions AS v ON v.user_id = e.user_id AND day_before >= v.effective_from"""
SQL["join_full_outer"] = """
    SELECT coalesce(t.employee_id, s.employee_id) AS employee_id, coalesce(t.month_date, s.month_date) AS month_date,
        CAST(target AS DOUBLE) AS target, CAST(sold AS DOUBLE) AS sold
    FROM (SELECT employee_id, target_month_date AS month_date, target_revenue AS target FROM stg_sales_targets_versioned WHERE is_latest) AS t
    FULL JOIN (SELECT employee_id, CAST(date_trunc('month', order_date) AS DATE) AS month_date, sum(net_amount) AS sold
        FROM stg_sales_transactions GROUP BY 1, 2) AS s ON s.employee_id = t.employee_id AND s.month_date = t.month_date"""

SQL["agg_employee_month"] = doubles(
    "actuals", "actual_quantity", "actual_gross_amount", "actual_discount_amount", "actual_revenue", "actual_total_cost", "actual_gross_profit",
    extra=", CAST(year(sales_month_date) AS INTEGER) AS sales_year, CAST(month(sales_month_date) AS INTEGER) AS sales_month",
)
SQL["agg_distributor_month"] = doubles(
    "distributor_months", *_MART_ORDERS, extra=", CAST(year(month_date) AS INTEGER) AS year, CAST(month(month_date) AS INTEGER) AS month"
)
SQL["agg_employee_month_by_order"], SQL["agg_distributor_month_by_order"] = SQL["agg_employee_month"], SQL["agg_distributor_month"]
SQL["agg_filter_count"] = """SELECT channel, count(*) FILTER (WHERE flag) AS on_time, count(*) FILTER (WHERE NOT flag) AS late,
    count(*) FILTER (WHERE flag IS NULL) AS unknown, count(delivery_status) AS with_status
    FROM (SELECT *, actual_delivery_date <= expected_delivery_date AS flag FROM stg_distributor_orders) GROUP BY channel"""
SQL["agg_safe_ratio"] = f"""SELECT product_id, {ratio('sum(qty_delivered)', 'sum(qty_ordered)')} AS fill_rate_pct,
    {ratio('sum(delivered_amount)', 'sum(gross_amount)', 4, 1)} AS delivered_ratio FROM stg_distributor_orders GROUP BY product_id"""
SQL["dup_keys"] = """SELECT order_id, distributor_id, product_id, count(*) AS row_count FROM raw_distributor_orders
    GROUP BY ALL HAVING count(*) > 1"""
SQL["dup_excess_rows"] = "SELECT count(*) - count(DISTINCT (order_id, product_id)) AS duplicate_count FROM raw_sales_transactions"


def rollup(mart: str, num: str, den: str, name: str) -> str:
    return f"""SELECT year, month, CAST(sum({num}) AS DOUBLE) AS {num}, CAST(sum({den}) AS DOUBLE) AS {den},
        {ratio(f'sum({num})', f'sum({den})')} AS {name} FROM {mart} GROUP BY year, month"""


SQL["monthly_achievement"] = rollup("mart_sales_vs_target", "actual_revenue", "target_revenue", "revenue_achievement_pct")
SQL["monthly_fill_rate"] = rollup("mart_distributor_performance", "total_qty_delivered", "total_qty_ordered", "fill_rate_pct")
SQL["distinct_unknown"] = "SELECT DISTINCT " + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in ("region", "province", "status")) + " FROM dim_customers"
SQL["dedupe_latest"] = newest(
    "(SELECT customer_id, customer_name, credit_limit, _ingested_at FROM raw_customer_master)", ("customer_id",), ("customer_name", "credit_limit")
)
SQL["dedupe_in_buckets"] = newest(
    "(SELECT order_id, product_id, order_date, net_amount, _ingested_at FROM raw_sales_transactions)",
    ("order_id", "product_id"), ("order_date", "net_amount"),
)
SQL["flag_latest_version"] = """SELECT l_partkey, CAST(l_shipdate AS DATE) AS shipped, l_orderkey, l_linenumber, l_suppkey,
    row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1 AS is_latest
    FROM lineitem"""
CTE["members"] = "SELECT DISTINCT province, channel, status FROM raw_customer_master"
SQL["surrogate_row_number"] = "SELECT row_number() OVER (ORDER BY province, channel, status) AS member_key, * FROM members"
SQL["surrogate_dense_rank"] = "SELECT DISTINCT dense_rank() OVER (ORDER BY province) AS province_key, province, channel FROM members"
SQL["surrogate_range_partitioned"] = """SELECT row_number() OVER (ORDER BY p_name, CAST(p_partkey AS VARCHAR)) AS product_number,
    p_name AS product_name, CAST(p_partkey AS VARCHAR) AS product_id FROM part"""



def newest_named(column: str) -> str:
    order = "printf('%05d%03d|%s|%s|%s', year, month, employee_name, coalesce(region, ''), coalesce(team, ''))"
    return f"arg_max(coalesce({column}, ''), CASE WHEN employee_name IS NOT NULL THEN {order} END) AS {column}"


CTE["employee_totals"] = f"""
    SELECT employee_id, {newest_named('employee_name')}, {newest_named('region')}, {newest_named('team')},
        CAST(sum(actual_revenue) AS DOUBLE) AS actual_revenue, CAST(sum(target_revenue) AS DOUBLE) AS target_revenue,
        CAST(sum(actual_quantity) AS DOUBLE) AS actual_quantity, CAST(sum(target_quantity) AS DOUBLE) AS target_quantity,
        CAST(sum(actual_gross_profit) AS DOUBLE) AS actual_gross_profit,
        CAST(sum(actual_revenue) - sum(target_revenue) AS DOUBLE) AS revenue_gap,
        {ratio('sum(actual_revenue)', 'sum(target_revenue)')} AS revenue_achievement_pct,
        {ratio('sum(actual_quantity)', 'sum(target_quantity)')} AS units_achievement_pct,
        {ratio('sum(actual_gross_profit)', 'sum(actual_revenue)')} AS gross_profit_margin_pct
    FROM mart_sales_vs_target GROUP BY employee_id"""
SQL["employee_detail"] = "SELECT * FROM employee_totals"
SQL["top_employees"] = "SELECT * FROM employee_totals WHERE employee_id IS NOT NULL ORDER BY actual_revenue DESC, employee_id LIMIT 10"
SQL["bottom_employees"] = """SELECT * FROM employee_totals WHERE employee_id IS NOT NULL AND revenue_achievement_pct IS NOT NULL
    ORDER BY revenue_achievement_pct, employee_id LIMIT 10"""

SQL["scalar_string"] = r"""SELECT c_custkey, lower(c_name) AS lowered, replace(lower(c_mktsegment), 'i', '') AS replaced,
    CASE WHEN c_nationkey <> 3 THEN c_mktsegment || '_' || c_nationkey END AS joined,
    c_mktsegment LIKE 'AUTO%' OR c_mktsegment LIKE 'BUILD%' AS matched, regexp_extract(c_name, '#0*([0-9]+)$', 1) AS digits,
    contains(c_name, '99') AS liked, c_name LIKE 'Customer#0000001%' AS alternation FROM customer"""
SQL["scalar_date_parts"] = """
    SELECT o_orderkey, day, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
        CAST(day(day) AS INTEGER) AS day_of_month, CAST(isodow(day) AS INTEGER) AS weekday, CAST(weekofyear(day) AS INTEGER) AS week,
        CAST(date_trunc('month', day) AS DATE) AS month_start, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key,
        monthname(day) AS month_name, dayname(day) AS day_name, day - 1 AS day_before,
        CAST(year(day) - CASE WHEN month(day) < 9 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year,
        CAST(((month(day) + 3) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)"""
SQL["scalar_case_null"] = f"""SELECT s_suppkey, {credit(7000, 3000, f"(CASE WHEN s_suppkey % 9 <> 0 THEN {money('s_acctbal')} END)")} AS tier,
    coalesce(NULLIF(s_nationkey, 7), -1) AS nation_or_minus_one, NULLIF(s_nationkey, 7) IS DISTINCT FROM 3 AS distinct_from_three,
    s_nationkey = 7 AS is_missing FROM supplier"""
_GROSS, _DISCOUNT = money("l_extendedprice"), money("l_discount")
SQL["scalar_math_round"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(round({_GROSS} * {_DISCOUNT}, 2) AS DOUBLE) AS rebate, CAST({_GROSS} - round({_GROSS} * {_DISCOUNT}, 2) AS DOUBLE) AS net,
    {ratio(_GROSS, money('l_quantity'), 2, 1)} AS unit_price, CAST(round(-{_GROSS} * {_DISCOUNT}, 1) AS DOUBLE) AS negative_rounded FROM lineitem"""


def bad_cells(column: str) -> str:
    return f"count(*) FILTER (WHERE NOT {usable(column)})"


def excess(table: str, grain) -> str:
    return f"(SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM {table} GROUP BY {', '.join(grain)}))"


SQL["profile_tables"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS profile_name, count(*) AS row_count, {excess('raw_' + t, s.grain)} AS duplicate_count,
    '{', '.join(s.grain)}' AS duplicate_columns, {" || ', ' || ".join(f"'{k}: ' || {bad_cells(k)}" for k in s.profile_keys)} AS key_nulls FROM raw_{t}"""
    for t, s in RAW.items()
)
SQL["profile_key_nulls"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS profile_name, '{k}' AS column_name, {bad_cells(k)} AS null_count, count(*) AS row_count,
    round({bad_cells(k)} * 100 / count(*), 2) AS null_pct FROM raw_{t}"""
    for t, s in RAW.items()
    for k in s.profile_keys
)
SQL["profile_duplicates"] = " UNION ALL ".join(
    f"SELECT '{t}' AS profile_name, {excess('raw_' + t, s.grain)} AS duplicate_count" for t, s in RAW.items()
)

_TARGETS = "stg_sales_targets_versioned"
_SILVER_KEYS = {**{t: s.key for t, s in TYPED.items()}, _TARGETS: ("version_label", "employee_id", "target_year", "month_col")}
_SILVER_REQUIRED = {**{t: s.required for t, s in TYPED.items()}, _TARGETS: ("version_label", "employee_id", "month_col")}
_DIM_KEYS = {
    "dim_date": ("date_key",), "dim_customers": ("customer_key",), "dim_products": ("product_key",),
    "dim_employees": ("employee_key",), "dim_distributors": ("distributor_key",),
}
_GRAINS = {
    "fact_sales": ("order_id", "product_id"), "fact_returns": ("return_id",),
    "fact_targets": ("employee_id", "target_year", "target_month"),
    "fact_distributor_orders": ("order_id", "distributor_id", "product_id"),
}
_FOREIGN = {
    "fact_sales": ("order_date_key", "customer_key", "product_key", "employee_key"),
    "fact_returns": ("return_date_key", "customer_key", "product_key", "employee_key"),
    "fact_targets": ("target_date_key", "employee_key"),
    "fact_distributor_orders": ("order_date_key", "distributor_key", "product_key"),
}


def check(layer: str, name: str, kind: str, value: str, source: str = "") -> str:
    return f"SELECT '{layer}' AS layer, '{name}' AS test_name, '{kind}' AS kind, CAST({value} AS BIGINT) AS value {source}"


def counts(layer: str, tables) -> str:
    return " UNION ALL ".join(check(layer, f"{t} row count", "result", "count(*)", f"FROM {t}") for t in tables)


def nulls(layer: str, keys, what: str | None = None) -> str:
    return " UNION ALL ".join(
        check(
            layer, f"{t} {what or (ks[0] if len(ks) == 1 else 'key') + ' nulls'}", "failures", "count(*)",
            f"FROM {t} WHERE {' OR '.join(f'{k} IS NULL' for k in ks)}",
        )
        for t, ks in keys.items()
    )


def repeated(layer: str, keys, names, where: str = "") -> str:
    return " UNION ALL ".join(
        check(
            layer, f"{t} duplicate {names.get(t, ks[0])}", "failures", "count(*)",
            f"FROM (SELECT 1 FROM {t} {where} GROUP BY {', '.join(ks)} HAVING count(*) > 1)",
        )
        for t, ks in keys.items()
    )


_KEY_NAMES = {
    "stg_employees": "employee effective record", "stg_territory_mapping": "mapping", "stg_sales_transactions": "order product",
    "stg_distributor_orders": "order distributor product", _TARGETS: "version target", "fact_sales": "order product",
    "fact_targets": "employee month", "fact_distributor_orders": "order distributor product",
}

SQL["dq_silver_row_counts"] = counts("silver", _SILVER_KEYS)
SQL["dq_silver_not_null"] = nulls("silver", _SILVER_REQUIRED)
SQL["dq_silver_unique"] = repeated("silver", _SILVER_KEYS, _KEY_NAMES)
SQL["dq_one_latest"] = repeated("silver", {_TARGETS: _GRAINS["fact_targets"]}, {_TARGETS: "latest target"}, "WHERE is_latest")
SQL["dq_gold_row_counts"] = counts("gold", [*_DIM_KEYS, *_GRAINS, "mart_sales_vs_target", "mart_distributor_performance"])
SQL["gold_footer_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in [*_DIM_KEYS, *_GRAINS, "mart_sales_vs_target", "mart_distributor_performance"]
)
SQL["dq_dim_not_null"] = nulls("gold", _DIM_KEYS)
SQL["dq_dim_unique"] = repeated("gold", _DIM_KEYS, {})
SQL["dq_fact_grain"] = repeated("gold", _GRAINS, _KEY_NAMES)
SQL["dq_order_keys_by_bucket"] = " UNION ALL ".join([
    repeated("silver", {t: _SILVER_KEYS[t] for t in ("stg_sales_transactions", "stg_distributor_orders")}, _KEY_NAMES),
    repeated("gold", {t: _GRAINS[t] for t in ("fact_sales", "fact_distributor_orders")}, _KEY_NAMES),
])
SQL["dq_missing_keys"] = nulls("gold", _FOREIGN, "missing dimension keys")


def dirty(sql: str, keys) -> str:
    """The same checks over tables with a second row of keys that end in 3, and for those in 5 one without key columns."""
    for t, ks in keys.items():
        ks = (ks,) if isinstance(ks, str) else ks
        last = f"right(CAST({ks[0]} AS VARCHAR), 1)"
        none = ", ".join(f"NULL AS {k}" for k in ks)
        rows = f"(SELECT * FROM {t} UNION ALL SELECT * FROM {t} WHERE {last} = '3' UNION ALL SELECT * REPLACE ({none}) FROM {t} WHERE {last} = '5')"
        sql = re.sub(rf"FROM {t}(?![A-Za-z0-9_])", f"FROM {rows}", sql)
    return sql


SQL["dq_silver_not_null_dirty"] = dirty(SQL["dq_silver_not_null"], _SILVER_REQUIRED)
SQL["dq_silver_unique_dirty"] = dirty(SQL["dq_silver_unique"], _SILVER_KEYS)
SQL["dq_one_latest_dirty"] = dirty(SQL["dq_one_latest"], {_TARGETS: _GRAINS["fact_targets"]})
SQL["dq_dim_not_null_dirty"] = dirty(SQL["dq_dim_not_null"], _DIM_KEYS)
SQL["dq_dim_unique_dirty"] = dirty(SQL["dq_dim_unique"], _DIM_KEYS)
SQL["dq_fact_grain_dirty"] = dirty(SQL["dq_fact_grain"], _GRAINS)
SQL["dq_rules_dirty"] = " UNION ALL ".join(
    check("gold", name, "failures", f"count(*) FILTER (WHERE {failing})", f"FROM {table}")
    for name, table, failing in (
        ("fact_targets latest flag check", "fact_targets", "employee_id LIKE '%3' OR is_latest IS DISTINCT FROM true"),
        ("mart_sales_vs_target negative target revenue", "mart_sales_vs_target", "employee_id LIKE '%3' OR target_revenue < 0"),
        ("mart_distributor_performance invalid fill rate", "mart_distributor_performance", "distributor_id LIKE '%3' OR NOT (fill_rate_pct BETWEEN 0 AND 100)"),
    )
)
SQL["dq_fiscal_year"] = check(
    "gold", "dim_date fiscal year check", "failures", "count(*)",
    "FROM dim_date WHERE date_day IN (DATE '2023-10-01', DATE '2024-01-01') AND fiscal_year <> 2023",
) + " UNION ALL " + check(
    "gold", "sales fiscal year check", "failures", "count(*)",
    "FROM stg_sales_transactions LEFT JOIN dim_date ON date_day = order_date WHERE fiscal_year IS DISTINCT FROM year(order_date) - CASE WHEN month(order_date) < 9 THEN 1 ELSE 0 END",
)
SQL["dq_latest_flag"] = check("gold", "fact_targets latest flag check", "failures", "count(*)", "FROM fact_targets WHERE is_latest IS DISTINCT FROM true")
SQL["dq_negative_target"] = check(
    "gold", "mart_sales_vs_target negative target revenue", "failures", "count(*)", "FROM mart_sales_vs_target WHERE target_revenue < 0"
)
SQL["dq_fill_rate_bounds"] = check(
    "gold", "mart_distributor_performance invalid fill rate", "failures", "count(*)",
    "FROM mart_distributor_performance WHERE NOT (fill_rate_pct BETWEEN 0 AND 100)",
)


_CHECKS = (
    "dq_silver_row_counts", "dq_silver_not_null", "dq_silver_unique", "dq_one_latest", "dq_gold_row_counts", "dq_dim_not_null",
    "dq_dim_unique", "dq_fact_grain", "dq_missing_keys", "dq_latest_flag", "dq_negative_target", "dq_fill_rate_bounds",
)
_CALENDAR = check("gold", "dim_date fiscal year check", "failures", "count(*)",
                  "FROM dim_date WHERE (date_day = DATE '2023-10-01' OR date_day = DATE '2024-01-01') AND fiscal_year <> 2023")
SQL["dq_all"] = " UNION ALL ".join([*(SQL[c] for c in _CHECKS), _CALENDAR])
_WRITTEN = ("stg_customers", "dim_date", "fact_targets", "fact_distributor_orders", "mart_sales_vs_target")
_ROW_RULES = [SQL[c] for c in _CHECKS if c not in ("dq_silver_unique", "dq_one_latest", "dq_dim_unique", "dq_fact_grain")]
SQL["dq_on_write"] = f"SELECT * FROM ({' UNION ALL '.join([*_ROW_RULES, _CALENDAR])}) WHERE split_part(test_name, ' ', 1) IN {_WRITTEN}"


def overview(by, where: str = "") -> str:
    return f"""SELECT {', '.join(by)}, CAST(sum(actual_revenue) AS DOUBLE) AS total_actual_revenue,
        CAST(sum(target_revenue) AS DOUBLE) AS total_target_revenue, CAST(sum(actual_revenue) - sum(target_revenue) AS DOUBLE) AS revenue_gap,
        {ratio('sum(actual_revenue)', 'sum(target_revenue)')} AS revenue_achievement_pct {{more}}
        FROM mart_sales_vs_target {where} GROUP BY {', '.join(by)}"""


SQL["kpi_sales_overview"] = overview(("year", "region")).format(
    more=f""", CAST(sum(actual_gross_profit) AS DOUBLE) AS gross_profit, {ratio('sum(actual_gross_profit)', 'sum(actual_revenue)')} AS gross_profit_margin_pct"""
)
SQL["target_by_month"] = overview(("year", "month")).format(more="")
SQL["target_by_region"] = overview(("region",)).format(more="")
SQL["kpi_units"] = f"""SELECT year, region, CAST(sum(actual_quantity) AS DOUBLE) AS total_units_sold, CAST(sum(target_quantity) AS DOUBLE) AS target_units,
    CAST(sum(actual_quantity) - sum(target_quantity) AS DOUBLE) AS units_gap, {ratio('sum(actual_quantity)', 'sum(target_quantity)')} AS units_achievement_pct
    FROM mart_sales_vs_target GROUP BY year, region"""
SQL["kpi_active_customers"] = "SELECT order_year, region, count(DISTINCT customer_id) AS active_customers FROM stg_sales_transactions GROUP BY order_year, region"
def activity(slicer: str, by: str, where: str = "") -> str:
    parts = [p for p in by.split(", ") if p]
    member = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '-')" for p in parts) or "''"
    return f"""SELECT '{slicer}' AS slicer, {member} AS member, count(DISTINCT customer_id) AS active_customers, count(DISTINCT order_id) AS total_orders,
        CAST(sum(net_amount) AS DOUBLE) AS revenue, CAST(sum(quantity) AS DOUBLE) AS units_sold
        FROM (SELECT *, year(order_date) AS year, CASE WHEN month(order_date) >= 9 THEN year(order_date) ELSE year(order_date) - 1 END AS fiscal_year,
            CAST(date_trunc('month', order_date) AS DATE) AS month_date FROM stg_sales_transactions) {where} {'GROUP BY ' + by if by else ''}"""


SQL["activity_by_slicer"] = " UNION ALL ".join(
    [activity(by.replace(" ", "") or "all", by) for by in ("", "year", "fiscal_year", "region", "channel", "region, province", "year, region, channel", "month_date")]
    + [activity("channel of ASIA in 2024", "channel", "WHERE year = 2024 AND region = 'ASIA'")]
)
SQL["stable_member_keys"] = """
    SELECT CASE WHEN channel > 'BUILDING' THEN n ELSE n + (SELECT count(DISTINCT (province, channel)) FROM members WHERE channel > 'BUILDING') END AS place_key, province, channel
    FROM (SELECT *, row_number() OVER (PARTITION BY channel > 'BUILDING' ORDER BY province, channel) AS n
          FROM (SELECT DISTINCT province, channel FROM members))"""
SQL["kpi_distributor"] = f"""SELECT year, CAST(sum(order_record_count) AS BIGINT) AS distributor_orders, CAST(sum(total_orders) AS BIGINT) AS distinct_orders, CAST(sum(total_gross_amount) AS DOUBLE) AS gross_order_value,
    CAST(sum(total_delivered_amount) AS DOUBLE) AS delivered_revenue, CAST(sum(total_qty_ordered) AS DOUBLE) AS qty_ordered,
    CAST(sum(total_qty_delivered) AS DOUBLE) AS qty_delivered, CAST(sum(on_time_delivery_count) AS BIGINT) AS on_time_deliveries,
    CAST(sum(late_delivery_count) AS BIGINT) AS late_deliveries, CAST(sum(delivery_record_count) AS BIGINT) AS delivery_records,
    {ratio('sum(total_qty_delivered)', 'sum(total_qty_ordered)')} AS quantity_fill_rate_pct,
    {ratio('sum(on_time_delivery_count)', 'sum(delivery_record_count)')} AS on_time_delivery_rate_pct
    FROM mart_distributor_performance GROUP BY year"""
CTE["delivered"] = """SELECT distributor_id, distributor_name, sum(total_delivered_amount) AS revenue, sum(total_qty_ordered) AS ordered,
    sum(total_qty_delivered) AS delivered, sum(on_time_delivery_count) AS on_time, sum(delivery_record_count) AS records
    FROM mart_distributor_performance GROUP BY ALL"""
SQL["revenue_contribution"] = f"""SELECT distributor_id, CAST(revenue AS DOUBLE) AS delivered_revenue,
    {ratio('revenue', '(SELECT sum(revenue) FROM delivered)', 4)} AS revenue_contribution_pct FROM delivered"""
SQL["distributor_action_priority"] = f"""
    SELECT distributor_id, distributor_name, CAST(revenue AS DOUBLE) AS delivered_revenue, {ratio('revenue', 'total', 4)} AS revenue_contribution_pct,
        {ratio('delivered', 'ordered')} AS quantity_fill_rate_pct, {ratio('on_time', 'records')} AS on_time_delivery_rate_pct
    FROM (SELECT *, sum(revenue) OVER () AS total, avg(CAST(revenue AS DOUBLE)) OVER () AS mean, sum(on_time) OVER () AS all_on_time, sum(records) OVER () AS all_records FROM delivered)
    WHERE CAST(revenue AS DOUBLE) >= mean AND {ratio('on_time', 'records')} < {ratio('all_on_time', 'all_records')}"""


def revenue(by: str, select: str = "", where: str = "") -> str:
    return f"""SELECT {select or by}, CAST(sum(net_amount) AS DOUBLE) AS revenue, CAST(sum(gross_profit) AS DOUBLE) AS gross_profit,
        CAST(sum(quantity) AS DOUBLE) AS units_sold, {ratio('sum(gross_profit)', 'sum(net_amount)')} AS gross_profit_margin_pct
        FROM fact_sales {where} GROUP BY {by}"""


SQL["revenue_by_region"] = revenue("region")
SQL["revenue_by_channel"] = revenue("channel")
SQL["revenue_by_province"] = revenue("region, province")
SQL["revenue_drilldown"] = " UNION ALL BY NAME ".join([
    f"SELECT *, 2 AS level FROM ({revenue('region, province')})",
    f"SELECT *, CAST(NULL AS VARCHAR) AS province, 1 AS level FROM ({revenue('region')})",
    f"SELECT * EXCLUDE (one), CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS province, 0 AS level FROM ({revenue('1', '1 AS one')})",
])
SQL["revenue_margin_trend"] = revenue("1", "CAST(date_trunc('month', order_date) AS DATE) AS month_date")
SQL["slice_channel"] = revenue("region, order_year", where="WHERE channel = 'BUILDING'")
SQL["slice_province"] = revenue("channel, order_year", where="WHERE province = 'CHINA'")
SQL["slice_fiscal_year"] = revenue("channel, fiscal_quarter", where="JOIN dim_date ON date_day = order_date WHERE fiscal_year = 2023")
SQL["slice_year"] = revenue("channel, order_quarter", where="WHERE year(order_date) = 2024 AND region = 'ASIA'")


def fulfilment(by: str) -> str:
    return f"""SELECT {by}, CAST(sum(total_delivered_amount) AS DOUBLE) AS delivered_revenue,
        {ratio('sum(total_qty_delivered)', 'sum(total_qty_ordered)')} AS quantity_fill_rate_pct,
        {ratio('sum(on_time_delivery_count)', 'sum(delivery_record_count)')} AS on_time_delivery_rate_pct,
        CAST(sum(late_delivery_count) AS BIGINT) AS late_deliveries, CAST(sum(delivery_record_count) AS BIGINT) AS delivery_records
        FROM mart_distributor_performance GROUP BY {by}"""


SQL["fulfilment_by_region"] = fulfilment("order_region")
SQL["late_by_channel"] = fulfilment("order_channel")


def statement(key: str) -> str:
    """The query's SELECT with the subqueries it needs, in definition order."""
    needed: set[str] = set()

    def collect(sql: str) -> None:
        for name in set(re.findall(r"\w+", sql)) & CTE.keys() - needed:
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                collect(CTE[name])

    collect(SQL[key])
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in needed - {name}:
            if re.search(rf"\b(?:FROM|JOIN)\s+{other}\b", CTE[name]):
                place(other)
        ordered.append(name)

    for name in sorted(needed):
        place(name)
    chain = ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered)
    return f"WITH {chain}\n{SQL[key]}" if ordered else SQL[key]


def statements() -> dict[str, str]:
    return {key: statement(key) for key in SQL}
