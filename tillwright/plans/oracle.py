"""DuckDB SQL for every registered query, written independently of the DataFrame code.

``_PARTS`` holds named sub-queries, from the raw tables up; ``sql(body)`` puts the ones a body needs in front of it.
Money and ratios leave as DOUBLE, counts and calendar parts as BIGINT, lists as comma-separated text, as in
``registry.portable``.
"""

from __future__ import annotations

import re


def _int(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '\\s*[+-]?[0-9]+\\s*') THEN try_cast(trim({x}) AS BIGINT) END"


def _price(x: str) -> str:
    return f"try_cast({x} AS DECIMAL(18,9))"


def _key(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"


def date_of(x: str) -> str:
    x = f"trim({x})"
    return (
        f"coalesce(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_strptime({x}, '%Y-%m-%d')::DATE END, "
        f"CASE WHEN regexp_full_match({x}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') THEN "
        f"coalesce(try_strptime({x}, '%m/%d/%Y')::DATE, try_strptime({x}, '%d/%m/%Y')::DATE) END)"
    )


def _first(source: str, key: str, columns: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    return (
        f"SELECT {key}, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS pick "
        f"FROM ({source}) t WHERE {key} IS NOT NULL) t WHERE pick = 1"
    )


_CUSTOMER = (
    "FirstName, LastName, CustomerName, CustomerEmail, CustomerPhone, CustomerAddress, CustomerCity, CustomerState, CustomerZip"
)

_PARTS = {
    # raw tables
    "cat_ids": "SELECT p_type, dense_rank() OVER (ORDER BY p_type) AS cid FROM part GROUP BY p_type",
    "raw_product_category": """
        SELECT cid::VARCHAR AS CategoryID, ' ' || p_type || ' ' AS CategoryName, lower(substr(p_type, 1, 2)) AS CategoryAbbreviation
        FROM cat_ids UNION ALL SELECT '99', 'UNUSED', 'un'""",
    "raw_products": """
        SELECT CASE WHEN p_partkey % 10 = 0 THEN ' P' || p_partkey || ' ' ELSE 'P' || p_partkey END AS ProdNumber,
               p_name || ' ' || p_partkey AS ProdName,
               CASE WHEN p_partkey % 97 = 5 THEN 'bad' ELSE cid::VARCHAR END AS Category,
               CASE WHEN p_partkey % 101 = 7 THEN '0' WHEN p_partkey % 103 = 9 THEN 'n/a' WHEN p_partkey % 59 = 3 THEN '19.995'
                    WHEN p_partkey % 61 = 4 THEN (p_size * 2.5 + 2.494567)::DECIMAL(12,6)::VARCHAR
                    ELSE (p_size * 2.5 + 2.49)::DECIMAL(10,2)::VARCHAR END AS Price
        FROM part JOIN cat_ids USING (p_type) JOIN range(2) AS copy(i) ON i = 0 OR p_partkey % 50 = 1""",
    "raw_customers": """
        SELECT CASE WHEN c_custkey % 53 = 11 THEN 'X' || c_custkey ELSE c_custkey::VARCHAR END AS CustomerID,
               'Customer' AS FirstName, ' ' || c_custkey || ' ' AS LastName,
               CASE WHEN c_custkey % 37 = 5 THEN NULL WHEN c_custkey % 47 = 6 THEN ' c' || c_custkey || '@example.com'
                    WHEN c_custkey % 41 = 4 THEN 'bad-email-' || c_custkey
                    WHEN c_custkey % 3 = 0 THEN 'C' || c_custkey || '@Example.com#mailto:C' || c_custkey || '@Example.com#'
                    WHEN c_custkey % 3 = 1 THEN 'mailto:c' || c_custkey || '@example.com'
                    ELSE 'c' || c_custkey || '@example.com' END AS CustomerEmail,
               '+1 (555) ' || lpad(c_custkey::VARCHAR, 7, '0') AS CustomerPhone,
               ' Street ' || c_custkey AS CustomerAddress,
               CASE WHEN c_custkey % 43 = 8 THEN '  ' WHEN c_custkey % 7 = 2 THEN n_name || ' ' ELSE n_name END AS CustomerCity,
               lower(c_mktsegment) AS CustomerState, lpad(c_nationkey::VARCHAR, 5, '0') AS CustomerZip
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "raw_orders": """
        SELECT l_orderkey::VARCHAR AS OrderID,
               CASE WHEN l_orderkey % 211 = 9 OR strftime(o_orderdate, '%Y-%m') = '1997-02' THEN NULL
                    WHEN l_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                    WHEN l_orderkey % 3 = 2 AND day(o_orderdate) > 12 THEN strftime(o_orderdate, '%d/%m/%Y')
                    ELSE strftime(o_orderdate, '%m/%d/%Y') END AS "Date",
               o_custkey::VARCHAR AS CustomerID,
               CASE WHEN l_partkey % 307 = 3 THEN 'ZZ' ELSE 'P' END || l_partkey AS ProdNumber,
               CASE WHEN (l_suppkey + l_linenumber) % 89 = 0 THEN '0' WHEN (l_suppkey + l_linenumber) % 97 = 0 THEN 'x'
                    ELSE l_quantity::BIGINT::VARCHAR END AS Quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    # staging
    "stg_customers": _first(
        f"""SELECT {_int("CustomerID")} AS CustomerID, trim(FirstName) AS FirstName, trim(LastName) AS LastName,
               trim(coalesce(FirstName, '') || ' ' || coalesce(LastName, '')) AS CustomerName,
               lower(regexp_replace(nullif(regexp_extract(CustomerEmail, '^[^#\\s]+'), ''), '^mailto:', '')) AS CustomerEmail,
               regexp_replace(CustomerPhone, '\\D', '', 'g') AS CustomerPhone, trim(CustomerAddress) AS CustomerAddress,
               trim(CustomerCity) AS CustomerCity, upper(trim(CustomerState)) AS CustomerState, trim(CustomerZip) AS CustomerZip
            FROM raw_customers""",
        "CustomerID",
        _CUSTOMER,
    ),
    "stg_product_category": _first(
        f"""SELECT {_int("CategoryID")} AS CategoryID, trim(CategoryName) AS CategoryName,
               upper(trim(CategoryAbbreviation)) AS CategoryAbbreviation FROM raw_product_category""",
        "CategoryID",
        "CategoryName, CategoryAbbreviation",
    ),
    "stg_products": _first(
        f"""SELECT * FROM (SELECT trim(ProdNumber) AS ProdNumber, trim(ProdName) AS ProdName, {_int("Category")} AS CategoryID,
               {_price("Price")} AS Price FROM raw_products) t WHERE CategoryID IS NOT NULL AND Price > 0""",
        "ProdNumber",
        "ProdName, CategoryID, Price",
    ),
    "stg_orders": f"""
        SELECT *, strftime(OrderDate, '%Y-%m') AS order_ym FROM (
            SELECT {_int("OrderID")} AS OrderID, {date_of('"Date"')} AS OrderDate, {_int("CustomerID")} AS CustomerID,
                   trim(ProdNumber) AS ProdNumber, {_int("Quantity")} AS Quantity FROM raw_orders) t
        WHERE OrderID IS NOT NULL AND OrderDate IS NOT NULL AND Quantity > 0
          AND CustomerID IN (SELECT CustomerID FROM stg_customers) AND ProdNumber IN (SELECT ProdNumber FROM stg_products)""",
    # master and enrichment
    "master": """
        SELECT c.CustomerEmail AS cust_email, c.CustomerCity AS cust_city, o.OrderDate AS order_date, o.Quantity AS order_qty,
               p.ProdName AS product_name, p.Price AS product_price, k.CategoryName AS category_name, o.Quantity * p.Price AS total_sales
        FROM stg_orders o, stg_customers c, stg_products p, stg_product_category k
        WHERE o.CustomerID = c.CustomerID AND o.ProdNumber = p.ProdNumber AND p.CategoryID = k.CategoryID""",
    "history": """
        SELECT *, min(order_date) OVER buyer AS first_order_date,
               row_number() OVER (PARTITION BY cust_email ORDER BY order_date, product_name, category_name, product_price, total_sales,
                                  cust_city NULLS FIRST, order_qty) AS order_seq,
               sum(total_sales) OVER buyer AS customer_ltv_gross, count(*) OVER buyer AS customer_total_lines
        FROM master WINDOW buyer AS (PARTITION BY cust_email)""",
    "city_all": """
        SELECT cust_city, sum(total_sales) AS city_sales,
               ntile(3) OVER (ORDER BY sum(total_sales) DESC, cust_city NULLS FIRST) AS city_ntile FROM master GROUP BY cust_city""",
    "city_year": """
        SELECT year(order_date) AS order_year, cust_city, sum(total_sales) AS city_sales,
               ntile(3) OVER (PARTITION BY year(order_date) ORDER BY sum(total_sales) DESC, cust_city NULLS FIRST) AS city_ntile
        FROM master GROUP BY 1, 2""",
    "cat_all": """
        SELECT category_name, sum(total_sales) AS category_sales,
               ntile(3) OVER (ORDER BY sum(total_sales) DESC, category_name NULLS FIRST) AS category_ntile FROM master GROUP BY category_name""",
    "cat_year": """
        SELECT year(order_date) AS order_year, category_name, sum(total_sales) AS category_sales,
               ntile(3) OVER (PARTITION BY year(order_date) ORDER BY sum(total_sales) DESC, category_name NULLS FIRST) AS category_ntile
        FROM master GROUP BY 1, 2""",
    "bucketed": """
        SELECT *, CASE WHEN product_price < 20 THEN 'Under 20' WHEN product_price < 50 THEN '20–49.99'
                       WHEN product_price < 100 THEN '50–99.99' ELSE '100+' END AS price_bucket FROM master""",
}


def _ext(per_year: bool) -> str:
    suffix, using = ("year", ", order_year") if per_year else ("all", "")
    city = f"city_{suffix}"
    cat = f"cat_{suffix}"
    return f"""
        SELECT h.*, strftime(order_date, '%Y-%m') AS order_ym, month(order_date) AS order_month, strftime(order_date, '%a') AS dow_name,
               dayofweek(order_date) + 1 AS dow_num, strftime(order_date, '%U')::BIGINT AS week_of_year,
               CASE WHEN product_price < 20 THEN 'Under 20' WHEN product_price < 50 THEN '20–49.99'
                    WHEN product_price < 100 THEN '50–99.99' ELSE '100+' END AS price_bucket,
               order_date - first_order_date AS days_since_first, order_seq > 1 AS is_repeat_customer,
               customer_ltv_gross::DOUBLE / customer_total_lines AS customer_avg_line_value,
               CASE city_ntile WHEN 1 THEN 'Tier 1 (Top)' WHEN 2 THEN 'Tier 2' ELSE 'Tier 3 (Emerging)' END AS city_tier,
               city_sales AS city_sales_total,
               CASE category_ntile WHEN 1 THEN 'Tier 1 (Core)' WHEN 2 THEN 'Tier 2' ELSE 'Tier 3 (Long tail)' END AS category_tier,
               category_sales AS category_sales_total
        FROM (SELECT *, year(order_date) AS order_year FROM history) h
        LEFT JOIN {city} USING (cust_city{using}) LEFT JOIN {cat} USING (category_name{using})"""


_PARTS["ext"] = _ext(False)
_PARTS["ext_year"] = _ext(True)

# star schema; the label of a key is that of its latest date, ties going to the greatest label
_PARTS["keyed"] = f"""
    SELECT (year(order_date) * 10000 + month(order_date) * 100 + day(order_date))::BIGINT AS date_key, order_date,
           strftime(order_date, '%Y-%m') AS order_ym,
           {_key("lower(trim(cust_email))")} AS customer_sk, lower(trim(cust_email)) AS email, trim(cust_city) AS line_city,
           {_key("upper(trim(product_name)) || '|' || upper(trim(category_name))")} AS product_sk,
           trim(product_name) AS line_product, trim(category_name) AS line_category, order_qty, total_sales, product_price
    FROM master WHERE cust_email IS NOT NULL"""
_PARTS["dim_customer"] = """
    SELECT DISTINCT ON (customer_sk) customer_sk, email AS customer_email, line_city AS city FROM keyed
    ORDER BY customer_sk, order_date DESC, line_city DESC NULLS LAST"""
_PARTS["dim_product"] = """
    SELECT DISTINCT ON (product_sk) product_sk, line_product AS product_name, line_category AS category_name FROM keyed
    ORDER BY product_sk, order_date DESC, line_product DESC, line_category DESC"""
_PARTS["dim_date"] = """
    SELECT (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT AS date_key, d AS "date", year(d)::BIGINT AS "year",
           quarter(d)::BIGINT AS quarter, month(d)::BIGINT AS "month", strftime(d, '%b') AS month_name_short,
           day(d)::BIGINT AS day_of_month, (dayofweek(d) + 1)::BIGINT AS day_of_week_num, strftime(d, '%a') AS day_of_week_name,
           strftime(d, '%U')::BIGINT AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(min(order_date)::TIMESTAMP, max(order_date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM master) t"""
_PARTS["fact"] = "SELECT date_key, customer_sk, product_sk, order_qty, total_sales, product_price FROM keyed"
_PARTS["base"] = """
    SELECT f.date_key, d."date" AS order_date, d."year", d."month", d.quarter, strftime(d."date", '%Y-%m') AS order_ym,
           d.day_of_week_num, d.day_of_week_name, f.customer_sk, c.customer_email, c.city, f.product_sk, p.product_name, p.category_name,
           f.order_qty, f.total_sales, f.product_price
    FROM fact f JOIN dim_date d USING (date_key) JOIN dim_customer c USING (customer_sk) JOIN dim_product p USING (product_sk)"""
_PARTS["monthly"] = """
    SELECT order_ym, min(order_date) AS month_start, max(order_date) AS month_end, sum(total_sales) AS sales, sum(order_qty) AS qty,
           count(DISTINCT customer_sk) AS active_customers, sum(total_sales)::DOUBLE / sum(order_qty) AS asp FROM base GROUP BY order_ym"""
_PARTS["aov"] = """
    SELECT order_ym, sum(total_sales) AS sales, count(DISTINCT (customer_sk, date_key)) AS orders_proxy,
           sum(total_sales)::DOUBLE / count(DISTINCT (customer_sk, date_key)) AS aov_proxy FROM base GROUP BY order_ym"""
_PARTS["rfm_values"] = """
    SELECT customer_sk, (SELECT max(order_date) FROM base) - max(order_date) AS recency_days,
           count(DISTINCT date_key) AS frequency_orders, sum(total_sales) AS monetary_value FROM base GROUP BY customer_sk"""
_PARTS["rfm"] = """
    SELECT *, CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 4 THEN 'Loyal'
                   WHEN r_score >= 4 AND greatest(f_score, m_score) <= 2 THEN 'New Customers'
                   WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk' WHEN r_score = 1 AND f_score <= 2 THEN 'Lost'
                   ELSE 'Regulars' END AS rfm_segment
    FROM (SELECT *, 6 - ntile(5) OVER (ORDER BY recency_days, customer_sk) AS r_score,
                 ntile(5) OVER (ORDER BY frequency_orders, customer_sk) AS f_score,
                 ntile(5) OVER (ORDER BY monetary_value, customer_sk) AS m_score FROM rfm_values) t"""
_PARTS["firsts"] = "SELECT customer_sk, min(order_date) AS start FROM base GROUP BY customer_sk"
_PARTS["cohort_counts"] = """
    SELECT strftime(start, '%Y-%m') AS cohort_ym, datediff('month', start, order_date) AS months_since_first,
           count(DISTINCT customer_sk) AS active_customers FROM base JOIN firsts USING (customer_sk) GROUP BY ALL"""
_PARTS["cohort"] = """
    SELECT a.*, z.active_customers AS cohort_size, a.active_customers::DOUBLE / z.active_customers AS retention_rate
    FROM cohort_counts a JOIN cohort_counts z ON z.cohort_ym = a.cohort_ym AND z.months_since_first = 0"""
_PARTS["pareto"] = """
    SELECT product_sk, product_name, category_name, sales, dense_rank() OVER (ORDER BY sales DESC) AS sales_rank,
           sales::DOUBLE / (sum(sales) OVER ())::DOUBLE AS sales_share,
           (sum(sales) OVER (ORDER BY sales DESC, product_sk ROWS UNBOUNDED PRECEDING))::DOUBLE / (sum(sales) OVER ())::DOUBLE AS cumulative_share
    FROM (SELECT product_sk, any_value(product_name) AS product_name, any_value(category_name) AS category_name, sum(total_sales) AS sales
          FROM base GROUP BY product_sk) t"""
_PARTS["clv"] = """
    SELECT customer_sk, min(order_date) AS first_purchase, max(order_date) AS last_purchase,
           datediff('month', min(order_date), max(order_date)) AS tenure_months, count(DISTINCT date_key) AS orders_proxy,
           sum(total_sales)::DOUBLE / count(DISTINCT date_key) AS aov_proxy, sum(total_sales) AS revenue_total FROM base GROUP BY customer_sk"""


def sql(body: str) -> str:
    """``body`` with every sub-query it refers to, directly or not, in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(_PARTS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({_PARTS[name].strip()})" for name in _PARTS if name in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
