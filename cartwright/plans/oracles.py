"""The SQL each registered query is checked against, over the same tables.

The statements share named subqueries; each one lists those it builds on. Money is exact cents, and
quotients are rounded half up in integer arithmetic, independently of how the queries do it.
"""

from __future__ import annotations

from cartwright.plans import queries as q

# Rules are written out here a second time, as SQL or as plain lists, and not taken from the code that is checked.
FIRST_DELIVERY = ("2024-04-01 00:00:00", "20240401_000000")
SECOND_DELIVERY = ("2024-04-02 00:00:00", "20240402_000000")
SEGMENT_8 = """CASE WHEN r_score>=4 AND f_score>=4 AND m_score>=4 THEN 'Champions'
    WHEN r_score>=3 AND f_score>=3 AND m_score>=3 THEN 'Loyal Customers'
    WHEN r_score>=4 AND f_score<=2 THEN 'New Customers'
    WHEN r_score>=3 AND f_score>=3 AND m_score<=2 THEN 'Potential Loyalists'
    WHEN r_score<=2 AND f_score>=4 THEN 'At Risk'
    WHEN r_score<=2 AND f_score<=2 AND m_score>=3 THEN 'Can''t Lose Them'
    WHEN r_score<=2 AND f_score<=2 THEN 'Lost Customers' ELSE 'Others' END"""
SEGMENT_12 = """CASE WHEN r_score>=4 AND f_score>=4 AND m_score>=4 THEN 'Champions'
    WHEN r_score>=3 AND f_score>=3 AND m_score>=3 THEN 'Loyal Customers'
    WHEN r_score>=4 AND f_score BETWEEN 2 AND 4 THEN 'Potential Loyalists'
    WHEN r_score>=4 AND f_score<=2 THEN 'New Customers'
    WHEN r_score>=3 AND f_score<=2 THEN 'Promising'
    WHEN r_score BETWEEN 2 AND 3 AND f_score BETWEEN 2 AND 3 THEN 'Need Attention'
    WHEN r_score<=3 AND f_score<=3 AND m_score<=3 THEN 'About to Sleep'
    WHEN r_score<=2 AND f_score>=3 THEN 'At Risk'
    WHEN r_score<=2 AND m_score>=4 THEN 'Cant Lose Them'
    WHEN r_score<=2 AND f_score<=2 THEN 'Hibernating'
    WHEN r_score=1 THEN 'Lost' ELSE 'Other' END"""
SEGMENT_6 = """CASE WHEN r_score>=4 AND f_score>=4 AND m_score>=4 THEN 'Champions'
    WHEN r_score>=3 AND f_score>=3 AND m_score>=3 THEN 'Loyal Customers'
    WHEN r_score>=4 AND f_score<=2 THEN 'New Customers'
    WHEN r_score<=2 AND f_score>=4 THEN 'At Risk'
    WHEN r_score<=2 AND f_score<=2 THEN 'Lost' ELSE 'Others' END"""
PRIORITY = """CASE WHEN r_score>=4 AND f_score>=4 AND m_score>=4 THEN 1 WHEN r_score<=2 AND m_score>=4 THEN 2
    WHEN r_score<=2 AND f_score>=3 THEN 3 WHEN r_score>=3 AND f_score>=3 AND m_score>=3 THEN 4
    WHEN r_score>=4 AND f_score<=2 THEN 5 ELSE 6 END"""
ACTION = """CASE customer_segment WHEN 'Champions' THEN 'VIP - Priority support'
    WHEN 'Loyal Customers' THEN 'High Value - Retention focus' WHEN 'Potential Loyalist' THEN 'High Value - Retention focus'
    WHEN 'New Customers' THEN 'Nurture - Welcome program' WHEN 'At Risk' THEN 'Win Back - Re-engagement'
    WHEN 'About to Sleep' THEN 'Win Back - Re-engagement' ELSE 'Standard' END"""
HEALTH = """CASE WHEN overall_conversion_rate>=5 THEN 'Excellent' WHEN overall_conversion_rate>=2 THEN 'Good'
    WHEN overall_conversion_rate>=1 THEN 'Average' ELSE 'Needs Improvement' END"""
PAYMENTS = [("credit_card", 40), ("debit_card", 70), ("paypal", 85), ("bank_transfer", 95)]
SEGMENTS_12 = [
    "Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "Promising", "Need Attention",
    "About to Sleep", "At Risk", "Cant Lose Them", "Hibernating", "Lost", "Other",
]
# Table: unique columns, columns without null, accepted values.
TESTS = {
    "stg_events": (
        ["event_id"],
        ["event_id", "event_time", "event_type", "user_id", "product_id", "price"],
        {"event_type": ["view", "cart", "purchase", "remove_from_cart"]},
    ),
    "stg_products": (["product_id"], ["product_id"], {}),
    "stg_users": (["user_id"], ["user_id", "first_seen", "last_seen", "total_events"], {}),
    "fct_daily_sales": (["sale_id"], ["sale_id", "sale_date", "total_revenue", "order_count"], {}),
    "fct_funnel": (["analysis_date"], ["analysis_date"], {}),
    "dim_customer_rfm": (
        ["user_id"],
        ["user_id", "recency", "frequency", "monetary", "customer_segment", "rfm_score"],
        {"customer_segment": SEGMENTS_12},
    ),
}
# Serving columns and types; the names are those of the gold tables but for the date.
SERVED = {
    "daily_sales": """sale_date date, category_level1 string, category_level2 string, order_count bigint,
        unique_customers bigint, unique_products bigint, total_revenue decimal(18,2), avg_order_value decimal(18,2),
        min_order_value decimal(18,2), max_order_value decimal(18,2), revenue_per_customer decimal(18,2), sale_year int,
        sale_month smallint, sale_quarter smallint, sale_week smallint, _aggregated_at timestamp""",
    "funnel_analysis": """analysis_date date, views bigint, carts bigint, purchases bigint, unique_viewers bigint,
        unique_carters bigint, unique_purchasers bigint, total_revenue decimal(18,2), view_to_cart_rate decimal(18,2),
        cart_to_purchase_rate decimal(18,2), overall_conversion_rate decimal(18,4), user_view_to_cart_rate decimal(18,2),
        user_cart_to_purchase_rate decimal(18,2), avg_revenue_per_purchaser decimal(18,2), analysis_year int,
        analysis_month smallint, _aggregated_at timestamp""",
    "customer_rfm": """user_id bigint, recency bigint, frequency bigint, monetary decimal(18,2), r_score smallint,
        f_score smallint, m_score smallint, rfm_score smallint, rfm_string string, customer_segment string,
        first_purchase_date date, last_purchase_date date, avg_order_value decimal(18,2), unique_products_bought bigint,
        segment_date date, _aggregated_at timestamp""",
    "product_performance": """product_id bigint, category_level1 string, category_level2 string, brand string, views bigint,
        carts bigint, purchases bigint, total_revenue decimal(18,2), avg_price decimal(18,2), unique_users bigint,
        cart_rate decimal(18,2), purchase_rate decimal(18,4), cart_to_purchase_rate decimal(18,2), revenue_rank bigint,
        purchase_rank bigint, _aggregated_at timestamp""",
}
QUANTITY_UNITS = [(10**15, "quadrillion"), (10**12, "trillion"), (10**9, "billion"), (10**6, "million"), (10**3, "thousand")]
RAW_COLUMNS = [
    "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session",
]

KEY = "event_time, event_type, product_id, user_id, user_session"
RAW = ", ".join(RAW_COLUMNS)


# Events as CSV lines; some are not as long as the header or have a word for a number.
_LINES = """SELECT *, event_id % 13 <> 0 AND event_id % 17 <> 0 AND event_id % 19 <> 0 AS good,
    concat(CASE WHEN event_id % 17 = 0 THEN concat_ws(',', event_id, user_id)
                ELSE concat_ws(',', event_id, user_id, event_type, CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE cast(floor(value)::bigint AS varchar) END) END,
           CASE WHEN event_id % 19 = 0 THEN ',extra,extra' ELSE '' END) AS line
    FROM events"""


def _div(num: str, den: str, scale: int) -> str:
    """Non-negative quotient rounded half up, null for a zero denominator."""
    return f"((2*({num})*{10**scale}+({den}))//nullif(2*({den}),0))/{10**scale}::double"


def _pct(part: str, whole: str, scale: int = 2) -> str:
    return _div(f"100*({part})", whole, scale)


def _mean(cents: str, count: str) -> str:
    return f"((2*({cents})+({count}))//nullif(2*({count}),0))/100::double"


def _usd(cents: str) -> str:
    return f"(({cents})/100.0::double)"


def _avg(cents: str, count: str) -> str:
    return f"(cast({cents} as double)/cast(({count})*100 as double))"


def _rounded(column: str) -> str:
    return f"cast(cast({column} as decimal(18,2)) as double)"


def _cents(column: str) -> str:
    return f"cast(cast({column} as decimal(18,2))*100 as bigint)"


def _n(kind: str) -> str:
    return f"cast(count(*) filter (where event_type='{kind}') as bigint)"


def _u(kind: str) -> str:
    return f"count(distinct case when event_type='{kind}' then user_id end)"


BOUGHT = "cast(coalesce(sum(cents) filter (where event_type='purchase'),0) as bigint)"
SUM_CENTS = "cast(sum(cents) as bigint)"


def _key_md5(*columns: str) -> str:
    return "md5(" + "||'|'||".join(f"coalesce(cast({c} as varchar),'_NULL_')" for c in columns) + ")"


def _draw(name: str, key: str, modulus: int) -> str:
    return f"(('0x'||substr(md5('{name}|'||cast({key} as varchar)),1,8))::bigint % {modulus})"


def _readable(hundredths: str) -> str:
    """Readable form of an amount given in hundredths."""
    text = f"printf('%d.%02d', ({hundredths})//100, ({hundredths})%100)"
    for size, unit in reversed(QUANTITY_UNITS):
        scaled = f"((2*({hundredths})+{size})//{2 * size})"
        text = f"CASE WHEN ({hundredths}) >= {size * 100} THEN printf('%d.%02d {unit}', {scaled}//100, {scaled}%100) ELSE {text} END"
    return text


def _session(user: str, time: str = "event_time") -> str:
    return f"concat_ws('_', cast({user} as varchar), strftime({time}, '%Y%m%d'), cast(hour({time})//4 as varchar))"


_first, _second = FIRST_DELIVERY, SECOND_DELIVERY
_LATEST_ORDER = (
    "_ingestion_time DESC, category_id DESC NULLS LAST, category_code DESC NULLS LAST, brand DESC NULLS LAST, "
    "price DESC NULLS LAST"
)

# Named subqueries: text and the names they build on.
CTES: dict[str, tuple[str, list[str]]] = {
    "keyed": (
        "SELECT *, try_cast(regexp_extract(props,'([0-9]+)',1) AS bigint) AS k FROM events",
        [],
    ),
    "mapped": (
        f"""SELECT event_id, ts + (CASE event_id%3 WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 0 END) * INTERVAL 1 DAY AS event_time,
        CASE WHEN event_type='click' AND day(ts)=7 THEN 'view' WHEN event_type IN ('view','error') AND day(ts)=8 THEN 'cart'
          WHEN event_type='click' THEN 'cart' WHEN event_type='signup' THEN 'remove_from_cart'
          WHEN event_type='purchase' THEN 'purchase' ELSE 'view' END AS event_type,
        CASE WHEN event_id%97<>0 THEN k END AS product_id, cast(p_size AS bigint) AS category_id,
        CASE WHEN k%10=0 THEN NULL WHEN k%10=1 THEN '  ' WHEN k%3=0 THEN lower(p_type)
          WHEN k%3=1 THEN lower(p_type)||'.size'||(p_size%5)
          ELSE ' '||lower(p_type)||'.size'||(p_size%5)||'.'||lower(replace(p_brand,'#','')) END AS category_code,
        CASE WHEN event_id%13=0 THEN NULL WHEN k%7=0 THEN '' ELSE ' '||p_brand||' ' END AS brand,
        CASE WHEN event_id%53=0 THEN NULL WHEN event_id%59=0 THEN -value WHEN event_id%61=0 THEN 0.0::double ELSE value END AS price,
        CASE WHEN event_id%101<>0 THEN user_id END AS user_id, user_id AS buyer
        FROM keyed LEFT JOIN part ON p_partkey = k""",
        ["keyed"],
    ),
    "bronze": (
        f"""SELECT event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
          {_session('buyer')} AS user_session, TIMESTAMP '{_first[0]}' AS _ingestion_time, '{_first[1]}' AS _batch_id FROM mapped
        UNION ALL SELECT event_time, event_type, product_id, category_id, category_code, brand, price+1, user_id,
          {_session('buyer')}, TIMESTAMP '{_second[0]}', '{_second[1]}' FROM mapped WHERE event_id%11=0""",
        ["mapped"],
    ),
    "latest_all": (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {_LATEST_ORDER}) AS rn FROM bronze) WHERE rn=1",
        ["bronze"],
    ),
    "latest": ("SELECT * FROM latest_all WHERE user_id IS NOT NULL AND product_id IS NOT NULL", ["latest_all"]),
    "named": (
        f"""SELECT * EXCLUDE (price, brand, category_code), price AS raw_price,
        CASE WHEN price IS NULL OR price<0 THEN 0.0::double ELSE price END AS price,
        CASE WHEN trim(coalesce(brand,''))='' THEN 'Unknown' ELSE trim(brand) END AS brand,
        CASE WHEN trim(coalesce(category_code,''))='' THEN 'uncategorized' ELSE trim(category_code) END AS category_code,
        cast(event_time AS date) AS event_date FROM latest""",
        ["latest"],
    ),
    "silver": (
        f"""SELECT *, {_cents('price')} AS cents, string_split(category_code,'.')[1] AS category_level1,
        coalesce(string_split(category_code,'.')[2],'general') AS category_level2,
        string_split(category_code,'.')[3] AS category_level3, lower(brand) AS brand_normalized,
        hour(event_time) AS event_hour, isodow(event_date) IN (6,7) AS is_weekend, year(event_date) AS event_year,
        month(event_date) AS event_month FROM named""",
        ["named"],
    ),
    "sales": (
        f"""SELECT event_date, category_level1, category_level2, count(*) AS order_count,
        count(distinct user_id) AS unique_customers, count(distinct product_id) AS unique_products,
        {SUM_CENTS} AS cents, min(price) AS min_order_value, max(price) AS max_order_value,
        year(event_date) AS sale_year, month(event_date) AS sale_month, quarter(event_date) AS sale_quarter,
        weekofyear(event_date) AS sale_week
        FROM silver WHERE event_type='purchase' GROUP BY event_date, category_level1, category_level2""",
        ["silver"],
    ),
    "counts": (
        f"""SELECT event_date, {_n('view')} AS views, {_n('cart')} AS carts, {_n('purchase')} AS purchases,
        {_u('view')} AS unique_viewers, {_u('cart')} AS unique_carters, {_u('purchase')} AS unique_purchasers,
        {BOUGHT} AS cents FROM silver GROUP BY event_date""",
        ["silver"],
    ),
    "funnel": (
        f"""SELECT event_date, views, carts, purchases, unique_viewers, unique_carters, unique_purchasers,
        {_usd('cents')} AS total_revenue, {_pct('carts','views')} AS view_to_cart_rate,
        coalesce({_pct('purchases','carts')},0) AS cart_to_purchase_rate,
        {_pct('purchases','views',4)} AS overall_conversion_rate,
        {_pct('unique_carters','unique_viewers')} AS user_view_to_cart_rate,
        coalesce({_pct('unique_purchasers','unique_carters')},0) AS user_cart_to_purchase_rate,
        coalesce({_mean('cents','unique_purchasers')},0) AS avg_revenue_per_purchaser,
        year(event_date) AS analysis_year, month(event_date) AS analysis_month FROM counts""",
        ["counts"],
    ),
    "buyers": (
        f"""SELECT user_id, count(*) AS frequency, {SUM_CENTS} AS cents, min(event_date) AS first_purchase_date,
        max(event_date) AS last_purchase_date, count(distinct product_id) AS unique_products_bought
        FROM silver WHERE event_type='purchase' GROUP BY user_id""",
        ["silver"],
    ),
    "scored": (
        """SELECT *, ntile(5) OVER (ORDER BY last_purchase_date, user_id) AS r_score,
        ntile(5) OVER (ORDER BY frequency, user_id) AS f_score, ntile(5) OVER (ORDER BY cents, user_id) AS m_score,
        datediff('day', last_purchase_date, (SELECT max(last_purchase_date) FROM buyers)) AS recency FROM buyers""",
        ["buyers"],
    ),
    "rfm": (
        f"""SELECT user_id, recency, frequency, {_usd('cents')} AS monetary, first_purchase_date, last_purchase_date,
        {_avg('cents','frequency')} AS avg_order_value, unique_products_bought, r_score, f_score, m_score,
        r_score+f_score+m_score AS rfm_score, r_score||''||f_score||''||m_score AS rfm_string,
        {SEGMENT_8} AS customer_segment,
        (SELECT max(last_purchase_date) FROM buyers) AS segment_date, cents FROM scored""",
        ["scored"],
    ),
    "products": (
        f"""SELECT product_id, category_level1, category_level2, brand, {_n('view')} AS views, {_n('cart')} AS carts,
        {_n('purchase')} AS purchases, {BOUGHT} AS cents, {_avg(SUM_CENTS,'count(*)')} AS avg_price,
        {_mean(SUM_CENTS, 'count(*)')} AS rounded_price, count(distinct user_id) AS unique_users
        FROM silver GROUP BY product_id, category_level1, category_level2, brand""",
        ["silver"],
    ),
    "performance": (
        f"""SELECT *, {_usd('cents')} AS total_revenue, coalesce({_pct('carts','views')},0) AS cart_rate,
        coalesce({_pct('purchases','views',4)},0) AS purchase_rate,
        coalesce({_pct('purchases','carts')},0) AS cart_to_purchase_rate,
        dense_rank() OVER (ORDER BY cents DESC) AS revenue_rank,
        dense_rank() OVER (ORDER BY purchases DESC) AS purchase_rank FROM products""",
        ["products"],
    ),
    "traffic": (
        f"""SELECT event_date, event_hour, event_type, count(*) AS event_count, count(distinct user_id) AS unique_users,
        count(distinct user_session) AS unique_sessions, {BOUGHT} AS cents FROM silver
        GROUP BY event_date, event_hour, event_type""",
        ["silver"],
    ),
    "third": (
        f"""SELECT * REPLACE (TIMESTAMP '2024-04-03 00:00:00' AS _ingestion_time, '{q.THIRD_BATCH}' AS _batch_id),
        {q.PAYMENT_METHODS}[user_id%3+1] AS payment_method FROM bronze
        WHERE _batch_id='{_second[1]}' AND event_type='purchase'""",
        ["bronze"],
    ),
    "v3": ("SELECT *, NULL::varchar AS payment_method FROM bronze UNION ALL SELECT * FROM third", ["bronze", "third"]),
    "stg_daily": (
        f"""SELECT {_key_md5('event_date','category_level1','category_level2')} AS sale_id, event_date AS sale_date,
        * EXCLUDE (event_date), {_usd('cents')} AS total_revenue FROM sales""",
        ["sales"],
    ),
    "users": (
        f"""SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen, count(*) AS total_events,
        {_n('view')} AS total_views, {_n('cart')} AS total_carts, {_n('purchase')} AS total_purchases, {BOUGHT} AS cents,
        count(distinct case when event_type='purchase' then product_id end) AS unique_products_purchased,
        count(distinct event_date) AS active_days FROM silver GROUP BY user_id""",
        ["silver"],
    ),
}


def _with(body: str, *names: str) -> str:
    """`body` preceded by the subqueries it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in CTES[name][1]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    listed = ",\n".join(f"{name} AS ({CTES[name][0]})" for name in ordered)
    return f"WITH {listed}\n{body}" if listed else body


SALES_COLUMNS = (
    f"event_date, category_level1, category_level2, order_count, unique_customers, unique_products, "
    f"{_usd('cents')} AS total_revenue, {_avg('cents','order_count')} AS avg_order_value, min_order_value, max_order_value, "
    f"{_mean('cents','unique_customers')} AS revenue_per_customer, sale_year, sale_month, sale_quarter, sale_week"
)
FUNNEL_COLUMNS = (
    "event_date, views, carts, purchases, unique_viewers, unique_carters, unique_purchasers, total_revenue, "
    "view_to_cart_rate, cart_to_purchase_rate, overall_conversion_rate, user_view_to_cart_rate, "
    "user_cart_to_purchase_rate, avg_revenue_per_purchaser, analysis_year, analysis_month"
)
RFM_COLUMNS = (
    "user_id, recency, frequency, monetary, first_purchase_date, last_purchase_date, avg_order_value, "
    "unique_products_bought, r_score, f_score, m_score, rfm_score, rfm_string, customer_segment, segment_date"
)
PERFORMANCE_COLUMNS = (
    "product_id, category_level1, category_level2, brand, views, carts, purchases, total_revenue, avg_price, "
    "unique_users, cart_rate, purchase_rate, cart_to_purchase_rate"
)
PRICE_TIER = (
    "CASE WHEN price=0 THEN 'free' WHEN price<10 THEN 'budget' WHEN price<50 THEN 'mid-range' "
    "WHEN price<200 THEN 'premium' ELSE 'luxury' END"
)
RAW_PRICE_TIER = (
    "CASE WHEN {p} IS NULL OR {p}=0 THEN 'free' WHEN {p}<10 THEN 'budget' WHEN {p}<50 THEN 'mid_range' "
    "WHEN {p}<200 THEN 'premium' ELSE 'luxury' END"
)
CLEAN_COLUMNS = (
    f"event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session, "
    f"category_level1, category_level2, category_level3, brand_normalized, event_hour, {{weekend}} AS is_weekend, "
    f"{PRICE_TIER} AS price_tier, event_date, event_year, event_month"
)
BRONZE_ID = "event_time, user_session, _batch_id"
CATEGORY = "CASE WHEN trim(coalesce(category_code,''))='' THEN 'uncategorized' ELSE trim(category_code) END"
BRAND = "CASE WHEN trim(coalesce(brand,''))='' THEN 'Unknown' ELSE trim(brand) END"
PRICE = "CASE WHEN price IS NULL OR price<0 THEN 0.0::double ELSE price END"

FCT_FUNNEL = f"""SELECT event_date AS analysis_date, views, carts, purchases, unique_viewers, unique_carters, unique_purchasers,
            {_usd('cents')} AS total_revenue, {_pct('carts','views')} AS view_to_cart_rate, {_pct('purchases','carts')} AS cart_to_purchase_rate,
            {_pct('purchases','views',4)} AS overall_conversion_rate, {_pct('unique_carters','unique_viewers')} AS user_view_to_cart_rate,
            {_pct('unique_purchasers','unique_carters')} AS user_cart_to_purchase_rate,
            {_pct('unique_purchasers','unique_viewers',4)} AS user_overall_conversion_rate,
            {_mean('cents','unique_purchasers')} AS avg_revenue_per_purchaser, {_mean('cents','purchases')} AS avg_order_value,
            year(event_date) AS analysis_year, month(event_date) AS analysis_month FROM counts"""


def _units(rate: str) -> str:
    return f"cast(sum(cast(round({rate}*10000) as bigint)) as bigint)"


def _mean_rate(rate: str, scale: int) -> str:
    return _div(_units(rate), f"count({rate})*10000", scale)


def _served_columns(table: str) -> list[tuple[str, str]]:
    """(name, type) of the serving columns."""
    return [tuple(part.split()) for part in SERVED[table].replace("(18,", "(18;").split(",")]


def _serve(table: str, source: dict[str, str]) -> str:
    """The serving columns but the audit time, with amounts that need rounding given in `source`."""
    renamed = {"sale_date": "event_date", "analysis_date": "event_date"} | source
    return ", ".join(f"{renamed.get(name, name)} AS {name}" for name, _ in _served_columns(table) if name != "_aggregated_at")


def _served_sql() -> dict[str, str]:
    """Table to the rows of its serving copy."""
    cents = ("total_revenue", "min_order_value", "max_order_value")
    sales = {"total_revenue": _usd("cents"), **{c: _rounded(c) for c in cents[1:]}}
    sales |= {"avg_order_value": _mean("cents", "order_count"), "revenue_per_customer": _mean("cents", "unique_customers")}
    return {
        "daily_sales": f"SELECT {_serve('daily_sales', sales)} FROM sales",
        "funnel_analysis": f"SELECT {_serve('funnel_analysis', {})} FROM funnel",
        "customer_rfm": f"SELECT {_serve('customer_rfm', {'avg_order_value': _mean('cents', 'frequency')})} FROM rfm",
        "product_performance": f"SELECT {_serve('product_performance', {'avg_price': 'rounded_price'})} FROM performance",
    }


def _serving_types() -> str:
    parts = []
    for table, body in _served_sql().items():
        for n, (name, kind) in enumerate(_served_columns(table)):
            counted = "*" if name == "_aggregated_at" else name
            parts.append(
                f"SELECT '{table}' AS table_name, {n}::bigint AS position, '{name}' AS column_name, "
                f"'{kind.replace(';', ',')}' AS data_type, (SELECT count({counted}) FROM ({body})) AS value_count"
            )
    return _with(" UNION ALL ".join(parts), "sales", "funnel", "rfm", "performance")


def _dq_tables() -> dict[str, tuple[str, list[str]]]:
    """The tested tables as subqueries."""
    return {
        "stg_events": (f"SELECT {_key_md5(*KEY.split(', '))} AS event_id, * FROM silver", ["silver"]),
        "stg_products": ("SELECT DISTINCT product_id FROM silver", ["silver"]),
        "stg_users": ("SELECT * FROM users", ["users"]),
        "fct_daily_sales": ("SELECT * FROM stg_daily", ["stg_daily"]),
        "fct_funnel": ("SELECT event_date AS analysis_date FROM counts", ["counts"]),
        "dim_customer_rfm": (
            f"""SELECT user_id, datediff('day', last_purchase_date, DATE '{q.AS_OF}') AS recency, frequency,
            cents AS monetary, r_score+f_score+m_score AS rfm_score,
            {SEGMENT_12} AS customer_segment FROM scored""",
            ["scored"],
        ),
    }


def _dq(*kinds: str) -> str:
    tables, parts, needed = _dq_tables(), [], set()
    for table, (unique, not_null, accepted) in TESTS.items():
        body, parents = tables[table]
        needed.update(parents)
        checks = []
        if "unique" in kinds:
            checks += [(c, "unique", f"(SELECT count(*) FROM (SELECT {c} FROM x GROUP BY {c} HAVING count(*)>1 AND {c} IS NOT NULL))") for c in unique]
        if "not_null" in kinds:
            checks += [(c, "not_null", f"(SELECT count(*) FROM x WHERE {c} IS NULL)") for c in not_null]
        if "accepted_values" in kinds:
            for c, values in accepted.items():
                listed = ",".join("'" + v + "'" for v in values)
                checks.append((c, "accepted_values", f"(SELECT count(*) FROM x WHERE {c} NOT IN ({listed}))"))
        for column, test, failures in checks:
            parts.append(
                f"SELECT * FROM (WITH x AS ({body}) SELECT '{table}' AS table_name, '{column}' AS column_name, "
                f"'{test}' AS test, {failures} AS failures)"
            )
    union = " UNION ALL ".join(parts)
    return _with(f"SELECT *, failures=0 AS passed FROM ({union})", *sorted(needed))


def oracle_sql() -> dict[str, str]:
    bronze = lambda columns: _with(f"SELECT {columns} FROM bronze", "bronze")
    silver = lambda columns: _with(f"SELECT {columns} FROM silver", "silver")
    sales = lambda body: _with(body, "sales")
    funnel = lambda body: _with(body, "funnel")
    rfm = lambda body: _with(body, "rfm")
    products = lambda body: _with(body, "performance")
    last_day = "(SELECT max(event_date) FROM sales)"
    categories = ",".join(f"'{c}'" for c in q.CATEGORIES)
    exported = f"SELECT event_date, category_level1, category_level2, order_count, unique_customers, {_usd('cents')} AS total_revenue FROM sales"
    gold_counts = (
        "SELECT 'daily_sales' AS table_name, count(*) AS n FROM sales UNION ALL SELECT 'funnel_analysis', count(*) FROM counts "
        "UNION ALL SELECT 'customer_rfm', count(*) FROM buyers UNION ALL SELECT 'product_performance', count(*) FROM products"
    )
    segment = lambda rule: rfm(f"SELECT user_id, r_score, f_score, m_score, {rule} AS segment FROM rfm")
    served = _served_sql()
    dated = (
        f"{RAW}, _ingestion_time, _batch_id, cast(event_time as date) AS event_date, year(event_time) AS event_year, "
        "month(event_time) AS event_month"
    )
    stg_events = silver(
        f"""{_key_md5(*KEY.split(', '))} AS event_id, event_time, event_date, event_year, event_month, day(event_date) AS event_day,
        event_hour, dayofweek(event_date)+1 AS day_of_week, event_type, product_id, category_id, category_code, category_level1,
        category_level2, category_level3, brand, brand_normalized, {_rounded('price')} AS price, {RAW_PRICE_TIER.format(p='raw_price')} AS price_tier,
        user_id, user_session, NULL::varchar AS payment_method, is_weekend, _ingestion_time, _batch_id"""
    )
    # The model of the first delivery alone.
    stg_first = stg_events.replace("FROM bronze", f"FROM (SELECT * FROM bronze WHERE _batch_id='{_first[1]}') AS bronze")
    monthly = f"""SELECT sale_year, sale_month, category_level1, cast(sum(order_count) as bigint) AS total_orders,
        cast(sum(unique_customers) as bigint) AS total_customers, {_usd(SUM_CENTS)} AS total_revenue FROM sales
        GROUP BY sale_year, sale_month, category_level1"""
    top_products = f"SELECT product_id, brand, category_level1, purchases, total_revenue, purchase_rate, revenue_rank FROM performance ORDER BY cents DESC, product_id, category_level1, category_level2, brand LIMIT "
    growth = "(cents-prev)"
    wow = f"""SELECT week_start, {_usd('cents')} AS weekly_revenue, {_usd('prev')} AS prev_week_revenue,
        sign({growth})*({_pct(f'abs({growth})', 'prev')}) AS wow_growth_pct FROM (
        SELECT *, lag(cents) OVER (ORDER BY week_start) AS prev FROM (
        SELECT event_date - cast(dayofweek(event_date) as integer) AS week_start, {SUM_CENTS} AS cents FROM sales GROUP BY 1))"""
    rfm_asof = f"""user_id, datediff('day', last_purchase_date, DATE '{q.AS_OF}') AS recency, frequency,
        {_usd('cents')} AS monetary, first_purchase_date, last_purchase_date, {_mean('cents','frequency')} AS avg_order_value,
        unique_products_bought, datediff('day', first_purchase_date, last_purchase_date) AS customer_lifespan_days"""
    payment_key = "user_session||'/'||cast(event_time as varchar)"
    payments = "'cash'"
    for label, chance in reversed(PAYMENTS):
        payments = f"CASE WHEN {_draw(f'payment-{label}', payment_key, 100)} < {chance} THEN '{label}' ELSE {payments} END"
    # The CSV reader gives null for an empty text.
    csv_raw = RAW.replace("brand", "nullif(brand,'') AS brand")
    raw_types = [
        ("event_time", "timestamp"), ("event_type", "string"), ("product_id", "bigint"), ("category_id", "bigint"),
        ("category_code", "string"), ("brand", "string"), ("price", "double"), ("user_id", "bigint"),
        ("user_session", "string"), ("_ingestion_time", "timestamp"), ("_source_file", "string"), ("_batch_id", "string"),
        ("event_date", "date"), ("event_year", "int"), ("event_month", "int"),
    ]
    schema_rows = " UNION ALL ".join(f"SELECT '{n}' AS column_name, '{t}' AS old_type, '{t}' AS new_type, 'kept' AS change" for n, t in raw_types)

    return {
        # scans, sources, sinks
        "scan_csv_events": bronze(csv_raw),
        "scan_csv_cast": bronze(csv_raw),
        "bronze_lineage": bronze(
            f"event_time, event_type, user_id, TIMESTAMP '{_first[0]}' AS _ingestion_time, '{_first[1]}' AS _batch_id, true AS from_csv"
        ),
        "bronze_partition_cols": bronze(
            "event_time, user_session, cast(event_time as date) AS event_date, year(event_time) AS event_year, month(event_time) AS event_month"
        ),
        "scan_table": silver(CLEAN_COLUMNS.format(weekend="is_weekend")),
        "scan_parquet": "SELECT * FROM events",
        "sink_partitioned_roundtrip": silver(CLEAN_COLUMNS.format(weekend="is_weekend")),
        "sink_append": bronze(f"{RAW}, _batch_id"),
        "compact_sorted": sales(f"SELECT {SALES_COLUMNS} FROM sales"),
        "curve_roundtrip": silver(KEY),
        "curve_file_ranges": silver(
            """count(*) AS row_count, min(event_time) AS least_event_time, max(event_time) AS greatest_event_time,
            min(product_id) AS least_product_id, max(product_id) AS greatest_product_id,
            min(user_id) AS least_user_id, max(user_id) AS greatest_user_id"""
        ),
        "sync_status": _with(
            f"SELECT table_name, n AS source_rows, n AS target_rows, true AS ok FROM ({gold_counts})",
            "sales", "counts", "buyers", "products",
        ),
        "row_count_reconcile": _with(
            f"SELECT table_name, n AS source_rows, n AS target_rows, true AS matches FROM ({gold_counts})",
            "sales", "counts", "buyers", "products",
        ),
        "export_csv_projected": sales(exported),
        "export_csv_single": sales(exported),
        "export_csv_text": bronze("user_session, _batch_id, brand, category_code"),
        "sink_truncate_reload": rfm(f"SELECT {RFM_COLUMNS} FROM rfm"),
        "external_table_read": products(f"SELECT {PERFORMANCE_COLUMNS}, revenue_rank, purchase_rank FROM performance"),
        "serve_daily_sales": sales(served["daily_sales"]),
        "serve_funnel": funnel(served["funnel_analysis"]),
        "serve_rfm": rfm(served["customer_rfm"]),
        "serve_products": products(served["product_performance"]),
        "serve_layout_roundtrip": sales(f"SELECT *, year(sale_date)*100+month(sale_date) AS month FROM ({served['daily_sales']})"),
        "serve_layout_funnel": funnel(
            f"SELECT *, year(analysis_date)*100+month(analysis_date) AS month FROM ({served['funnel_analysis']})"
        ),
        "serve_layout_rfm": rfm(served["customer_rfm"]),
        "serve_layout_products": products(served["product_performance"]),
        "serving_types": _serving_types(),
        "namespace_tables": "SELECT 'shop' AS namespace, unnest(['listed_sales', 'listed_funnel']) AS table_name",
        "model_as_table": _with(FCT_FUNNEL, "counts"),
        "model_as_view": sales(
            "SELECT event_date, category_level1, cast(sum(order_count) as bigint) AS order_count FROM sales GROUP BY 1, 2"
        ),
        "data_files": silver("event_year, event_month, count(*) AS record_count, 1::bigint AS file_count")
        + " GROUP BY event_year, event_month",
        "event_sample": "SELECT * FROM events ORDER BY event_id LIMIT 5",
        "sorted_table": _with("SELECT event_date, row_number() OVER (ORDER BY event_date) AS position FROM counts", "counts"),
        "sorted_positions": silver(f"{KEY}, row_number() OVER (ORDER BY {KEY}) AS position"),
        "scan_csv_checked": f"""SELECT CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN user_id END AS user_id,
            CASE WHEN good THEN event_type END AS event_type, CASE WHEN good THEN floor(value)::bigint END AS amount,
            CASE WHEN NOT good THEN line END AS rejected_line FROM ({_LINES})""",
        "scan_csv_quarantine": f"""SELECT count(*) FILTER (WHERE good) AS kept, count(*) FILTER (WHERE NOT good) AS rejected, count(*) AS lines,
            count(*) FILTER (WHERE good) AS table_rows, count(*) FILTER (WHERE NOT good) AS quarantine_rows FROM ({_LINES})""",
        "namespace_row_counts": _with(
            """SELECT 'shop' AS namespace, 'counted_sales' AS table_name, (SELECT count(*) FROM sales) AS row_count
            UNION ALL SELECT 'shop', 'counted_funnel', (SELECT count(*) FROM funnel)""",
            "sales", "funnel",
        ),
        # cleaning and scalar rules
        "clean_brand": bronze(f"{BRONZE_ID}, {BRAND} AS brand"),
        "clean_category": bronze(f"{BRONZE_ID}, {CATEGORY} AS category_code"),
        "clean_price": bronze(f"{BRONZE_ID}, {PRICE} AS price"),
        "clean_price_rounded": bronze(f"{BRONZE_ID}, cast(cast({PRICE} as decimal(18,2)) as double) AS price"),
        "category_levels": _with(
            f"""SELECT event_time, user_session, p[1] AS category_level1, coalesce(p[2],'general') AS category_level2, p[3] AS category_level3
            FROM (SELECT *, string_split({CATEGORY},'.') AS p FROM bronze)""",
            "bronze",
        ),
        "brand_normalized": bronze(f"{BRONZE_ID}, lower({BRAND}) AS brand_normalized"),
        "price_tier": _with(
            f"SELECT {BRONZE_ID}, {PRICE_TIER} AS price_tier FROM (SELECT * REPLACE ({PRICE} AS price) FROM bronze)", "bronze"
        ),
        "price_tier_raw": bronze(f"{BRONZE_ID}, {RAW_PRICE_TIER.format(p='price')} AS price_tier"),
        "event_hour": bronze(f"{BRONZE_ID}, hour(event_time) AS event_hour"),
        "is_weekend": bronze(f"{BRONZE_ID}, isodow(event_time) >= 6 AS is_weekend"),
        "is_weekend_compat": bronze(f"{BRONZE_ID}, day(event_time) IN (0,6) AS is_weekend"),
        "date_parts": bronze(
            """event_time, user_session, year(event_time) AS event_year, month(event_time) AS event_month, day(event_time) AS event_day,
            quarter(event_time) AS event_quarter, weekofyear(event_time) AS event_week, dayofweek(event_time)+1 AS event_day_of_week"""
        ),
        "valid_events": _with(
            f"SELECT {RAW}, _batch_id FROM bronze WHERE user_id IS NOT NULL AND product_id IS NOT NULL", "bronze"
        ),
        "dedupe_latest": _with(f"SELECT {RAW}, _ingestion_time FROM latest_all", "latest_all"),
        "dedupe_any": bronze(f"DISTINCT {KEY}"),
        "events_cleaned": silver(CLEAN_COLUMNS.format(weekend="is_weekend")),
        "events_cleaned_compat": silver(CLEAN_COLUMNS.format(weekend="(day(event_date) IN (0,6))")),
        "stg_events": stg_events,
        "surrogate_key": bronze(f"{BRONZE_ID}, {_key_md5(*KEY.split(', '))} AS event_id"),
        "date_range_filter": _with(
            f"SELECT {RAW} FROM bronze WHERE cast(event_time as date) >= DATE '{q.RANGE_FIRST}' AND cast(event_time as date) <= DATE '{q.RANGE_LAST}'",
            "bronze",
        ),
        "cents_to_dollars": silver("event_time, user_session, cents/100.0::double AS dollars"),
        "conversion_rate_zero": products(
            f"SELECT product_id, category_level1, category_level2, brand, coalesce({_pct('carts','views',4)},0) AS rate FROM performance"
        ),
        "conversion_rate_null": products(
            f"SELECT product_id, category_level1, category_level2, brand, {_pct('carts','views')} AS rate FROM performance"
        ),
        "sql_functions": products(
            f"""SELECT product_id, category_level1, category_level2, brand, coalesce({_pct('carts','views',4)},0) AS rate,
            {_pct('carts','views',4)} AS rate_or_null, purchases/100.0::double AS dollars,
            {_key_md5('product_id', 'category_level1', 'brand')} AS key FROM performance"""
        ),
        "session_bucket": silver(f"event_time, user_id, {_session('user_id')} AS session"),
        "rfm_segments_8": segment(SEGMENT_8),
        "rfm_segments_12": segment(SEGMENT_12),
        "rfm_segments_6": segment(SEGMENT_6),
        "readable_quantity": sales(
            f"""SELECT category_level1, {_usd('c')} AS revenue, o AS orders, {_readable('c')} AS revenue_text, {_readable('o*100')} AS orders_text
            FROM (SELECT category_level1, {SUM_CENTS} AS c, cast(sum(order_count) as bigint) AS o FROM sales GROUP BY 1)"""
        ),
        "backfill_default": _with(
            f"SELECT event_type, coalesce(payment_method, {payments}) AS payment_method, count(*) AS event_count FROM v3 GROUP BY 1, 2", "v3"
        ),
        "dashboard_filters": sales(
            f"SELECT event_date, category_level1, category_level2, {_usd('cents')} AS total_revenue FROM sales WHERE event_date >= {last_day} - 30 AND category_level1 IN ({categories})"
        ),
        # dimensions and gold tables
        "dim_products": _with(
            f"""SELECT product_id, category_id, category_code, brand, any_value(category_level1) AS category_level1,
            any_value(category_level2) AS category_level2, any_value(category_level3) AS category_level3,
            any_value(brand_normalized) AS brand_normalized, {_avg(SUM_CENTS,'count(*)')} AS avg_price, min(price) AS min_price,
            max(price) AS max_price, count(*) AS total_events, {_n('view')} AS view_count, {_n('cart')} AS cart_count,
            {_n('purchase')} AS purchase_count FROM silver GROUP BY product_id, category_id, category_code, brand""",
            "silver",
        ),
        "stg_products": _with(
            f"""SELECT s.product_id, l.category_id, l.category_code, l.category_level1, l.category_level2, l.category_level3, l.brand,
            l.brand_normalized, {_mean(SUM_CENTS, 'count(*)')} AS avg_price, {_rounded('min(s.price)')} AS min_price, {_rounded('max(s.price)')} AS max_price,
            count(*) AS total_events, {_n('view')} AS view_count, {_n('cart')} AS cart_count, {_n('purchase')} AS purchase_count,
            {_pct(_n('cart'), _n('view'))} AS view_to_cart_rate, {_pct(_n('purchase'), _n('cart'))} AS cart_to_purchase_rate
            FROM silver s JOIN (SELECT product_id, category_id, category_code, category_level1, category_level2, category_level3, brand, brand_normalized
              FROM silver QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_time DESC, category_id DESC NULLS LAST, category_code DESC, brand DESC)=1) l
              ON l.product_id = s.product_id GROUP BY ALL""".replace("cents)", "s.cents)").replace("event_type=", "s.event_type="),
            "silver",
        ),
        "dim_users": _with(
            f"""SELECT user_id, first_seen, last_seen, total_events, total_views, total_carts, total_purchases, {_usd('cents')} AS total_spent,
            total_purchases AS purchase_count, coalesce({_avg('cents','nullif(total_purchases,0)')},0) AS avg_order_value,
            total_purchases>0 AS is_buyer FROM users""",
            "users",
        ),
        "stg_users": _with(
            f"""SELECT user_id, first_seen, last_seen, datediff('day', first_seen, last_seen) AS days_active, total_events, total_views,
            total_carts, total_purchases, {_usd('cents')} AS total_spent, unique_products_purchased, active_days, total_purchases>0 AS is_buyer,
            coalesce({_mean('cents','total_purchases')},0) AS avg_order_value, {_div('total_events','active_days',2)} AS avg_events_per_day,
            {_pct('total_carts','total_views')} AS view_to_cart_rate, {_pct('total_purchases','total_carts')} AS cart_to_purchase_rate FROM users""",
            "users",
        ),
        "daily_sales": sales(f"SELECT {SALES_COLUMNS} FROM sales"),
        "fct_daily_sales": _with(
            f"""SELECT sale_id, sale_date, category_level1, category_level2, order_count, unique_customers, unique_products, total_revenue,
            {_mean('cents','order_count')} AS avg_order_value, {_rounded('min_order_value')} AS min_order_value,
            {_rounded('max_order_value')} AS max_order_value, {_mean('cents','unique_customers')} AS revenue_per_customer, {_div('order_count','unique_customers',2)} AS orders_per_customer,
            sale_year, sale_month, sale_quarter, sale_week, dayofweek(sale_date)+1 AS sale_day_of_week, isodow(sale_date)>=6 AS is_weekend FROM stg_daily""",
            "stg_daily",
        ),
        "funnel_daily": funnel(f"SELECT {FUNNEL_COLUMNS} FROM funnel"),
        "fct_funnel": _with(FCT_FUNNEL, "counts"),
        "funnel_overall": _with(
            f"""SELECT *, {_pct('total_carts','total_views')} AS overall_view_to_cart_pct, {_pct('total_purchases','total_carts')} AS overall_cart_to_purchase_pct,
            {_pct('total_purchases','total_views',4)} AS overall_conversion_pct FROM (SELECT cast(sum(views) as bigint) AS total_views,
            cast(sum(carts) as bigint) AS total_carts, cast(sum(purchases) as bigint) AS total_purchases FROM counts)""",
            "counts",
        ),
        "rfm_base": rfm(
            "SELECT user_id, recency, frequency, monetary, first_purchase_date, last_purchase_date, avg_order_value, unique_products_bought FROM rfm"
        ),
        "rfm_base_asof": _with(f"SELECT {rfm_asof} FROM buyers", "buyers"),
        "customer_rfm": rfm(f"SELECT {RFM_COLUMNS} FROM rfm"),
        "dim_customer_rfm": _with(
            f"""SELECT {rfm_asof}, r_score, f_score, m_score, r_score+f_score+m_score AS rfm_score,
            r_score||''||f_score||''||m_score AS rfm_string, {SEGMENT_12} AS customer_segment,
            cast({PRIORITY} as bigint) AS segment_priority, DATE '{q.AS_OF}' AS segment_date FROM scored""",
            "scored",
        ),
        "hourly_traffic": _with(
            f"""SELECT event_date, event_hour, event_type, event_count, unique_users, unique_sessions, {_usd('cents')} AS revenue,
            dayofweek(event_date)+1 AS day_of_week FROM traffic""",
            "traffic",
        ),
        "hourly_traffic_compat": _with(
            f"""SELECT event_date, event_hour, event_type, event_count, unique_users, unique_sessions, {_usd('cents')} AS revenue,
            day(event_date)%7 AS day_of_week FROM traffic""",
            "traffic",
        ),
        "product_performance": products(f"SELECT {PERFORMANCE_COLUMNS} FROM performance"),
        "product_ranks": products(f"SELECT {PERFORMANCE_COLUMNS}, revenue_rank, purchase_rank FROM performance"),
        # annotated views
        "stg_daily_sales": sales(
            f"""SELECT event_date, category_level1, category_level2, order_count, unique_customers, unique_products, {_usd('cents')} AS total_revenue,
            {_avg('cents','order_count')} AS avg_order_value, sale_year, sale_month, {_mean('cents','order_count')} AS revenue_per_order,
            {_div('order_count','unique_customers',2)} AS orders_per_customer FROM sales"""
        ),
        "stg_customer_rfm": rfm(
            f"SELECT {RFM_COLUMNS}, {ACTION} AS action_recommendation FROM rfm"
        ),
        "stg_funnel_analysis": funnel(
            f"SELECT {FUNNEL_COLUMNS}, {HEALTH} AS funnel_health FROM funnel"
        ),
        "sales_quality_flags": sales(
            f"""SELECT event_date, category_level1, category_level2, order_count, {_usd('cents')} AS total_revenue,
            {_mean('cents','order_count')} AS avg_order_value, CASE WHEN cents=0 THEN 'ISSUE: Zero revenue'
            WHEN cents/order_count > 500000 THEN 'High AOV' ELSE 'Low AOV' END AS quality_flag
            FROM sales WHERE cents/order_count > 500000 OR cents/order_count < 500"""
        ),
        # reports
        "segment_distribution": rfm(
            f"""SELECT customer_segment, customer_count, {_pct('customer_count','everyone')} AS percentage, {_mean('c','customer_count')} AS avg_monetary,
            {_div('f','customer_count',1)} AS avg_frequency, {_div('r','customer_count',1)} AS avg_recency FROM (
            SELECT customer_segment, count(*) AS customer_count, (SELECT count(*) FROM rfm) AS everyone, {SUM_CENTS} AS c,
            cast(sum(frequency) as bigint) AS f, cast(sum(recency) as bigint) AS r FROM rfm GROUP BY customer_segment)"""
        ),
        "revenue_by_month": sales(
            f"""SELECT sale_year, sale_month, {_readable('c')} AS total_revenue, {_readable('o*100')} AS total_orders, {_mean('c','o')} AS avg_order_value
            FROM (SELECT sale_year, sale_month, {SUM_CENTS} AS c, cast(sum(order_count) as bigint) AS o FROM sales GROUP BY 1, 2)"""
        ),
        "revenue_last_30d": sales(
            f"""SELECT event_date AS sale_date, {_usd(SUM_CENTS)} AS daily_revenue, cast(sum(order_count) as bigint) AS daily_orders
            FROM sales WHERE event_date >= {last_day} - 30 GROUP BY 1"""
        ),
        "revenue_trend": sales(f"SELECT event_date AS sale_date, {_usd(SUM_CENTS)} AS revenue FROM sales GROUP BY 1"),
        "revenue_by_weekday": sales(
            f"""SELECT isodow(event_date) AS day_of_week, dayname(event_date) AS day_name, {_usd(SUM_CENTS)} AS revenue,
            {_mean(SUM_CENTS,'count(*)')} AS avg_daily_revenue FROM sales GROUP BY 1, 2"""
        ),
        "avg_conversion_rates": funnel(
            f"""SELECT {_mean_rate('view_to_cart_rate',2)} AS avg_view_to_cart, {_mean_rate('cart_to_purchase_rate',2)} AS avg_cart_to_purchase,
            {_mean_rate('overall_conversion_rate',4)} AS avg_overall_conversion,
            {_mean(f"cast(sum({_cents('avg_revenue_per_purchaser')}) as bigint)", 'count(*)')} AS avg_revenue_per_purchaser FROM funnel"""
        ),
        "funnel_by_month": _with(
            f"""SELECT *, {_pct('total_carts','total_views')} AS view_to_cart_rate, {_pct('total_purchases','total_carts')} AS cart_to_purchase_rate FROM (
            SELECT year(event_date) AS analysis_year, month(event_date) AS analysis_month, cast(sum(views) as bigint) AS total_views,
            cast(sum(carts) as bigint) AS total_carts, cast(sum(purchases) as bigint) AS total_purchases FROM counts GROUP BY 1, 2)""",
            "counts",
        ),
        "rfm_score_hist": rfm(
            f"SELECT rfm_score, count(*) AS customer_count, {_usd(SUM_CENTS)} AS total_revenue, {_mean(SUM_CENTS,'count(*)')} AS avg_monetary FROM rfm GROUP BY rfm_score"
        ),
        "category_performance": products(
            f"""SELECT *, {_pct('total_purchases','total_views',4)} AS avg_purchase_rate FROM (SELECT category_level1, count(*) AS product_count,
            cast(sum(views) as bigint) AS total_views, cast(sum(purchases) as bigint) AS total_purchases, {_usd(SUM_CENTS)} AS total_revenue
            FROM performance GROUP BY category_level1)"""
        ),
        "hourly_pattern": _with(
            f"""SELECT event_hour, cast(sum(event_count) as bigint) AS total_events, cast(sum(unique_users) as bigint) AS unique_users,
            {_usd(SUM_CENTS)} AS revenue FROM traffic GROUP BY event_hour""",
            "traffic",
        ),
        "mv_monthly_sales": sales(monthly),
        "stream_monthly_sales": sales(monthly),
        "mv_segment_summary": rfm(
            f"""SELECT customer_segment, count(*) AS customer_count, {_usd(SUM_CENTS)} AS total_revenue,
            cast(sum(recency) as double)/count(*) AS avg_recency, cast(sum(frequency) as double)/count(*) AS avg_frequency FROM rfm GROUP BY customer_segment"""
        ),
        "revenue_by_category": sales(f"SELECT category_level1, {_usd(SUM_CENTS)} AS revenue FROM sales GROUP BY 1"),
        "customers_by_segment": rfm("SELECT customer_segment, count(*) AS customers FROM rfm GROUP BY 1"),
        "kpi_summary": _with(
            f"""SELECT * FROM (SELECT {_usd(SUM_CENTS)} AS total_revenue, cast(sum(order_count) as bigint) AS total_orders,
            {_mean(SUM_CENTS,'cast(sum(order_count) as bigint)')} AS avg_order_value FROM sales),
            (SELECT count(*) AS total_customers, count(*) FILTER (WHERE customer_segment='Champions') AS champion_customers,
            {_mean(SUM_CENTS,'count(*)')} AS avg_customer_ltv FROM rfm),
            (SELECT {_mean_rate('overall_conversion_rate',4)} AS avg_conversion_rate, {_mean_rate('cart_to_purchase_rate',2)} AS avg_cart_conversion FROM funnel)""",
            "sales", "rfm", "funnel",
        ),
        "kpi_cards": _with(
            f"""SELECT * FROM (SELECT {_usd(SUM_CENTS)} AS total_revenue, cast(sum(order_count) as bigint) AS total_orders FROM sales),
            (SELECT {_div('100*' + _units('overall_conversion_rate'), 'count(overall_conversion_rate)*10000', 2)} AS avg_conversion_rate FROM funnel),
            (SELECT count(*) AS total_customers FROM buyers)""",
            "sales", "funnel", "buyers",
        ),
        "table_profile": sales(
            f"SELECT count(*) AS total_records, count(distinct event_date) AS unique_dates, min(event_date) AS min_date, max(event_date) AS max_date, {_usd(SUM_CENTS)} AS total_revenue FROM sales"
        ),
        "monthly_stats": sales(
            f"SELECT sale_year, sale_month, count(*) AS days_with_data, cast(sum(order_count) as bigint) AS total_orders, {_usd(SUM_CENTS)} AS total_revenue FROM sales GROUP BY 1, 2"
        ),
        "monthly_trend_range": sales(
            f"""SELECT strftime(event_date,'%Y-%m') AS month, cast(sum(order_count) as bigint) AS orders, {_usd(SUM_CENTS)} AS revenue FROM sales
            WHERE event_date >= DATE '{q.TREND_FIRST}' AND event_date < DATE '{q.TREND_BEFORE}' GROUP BY 1"""
        ),
        "event_type_counts": _with(
            f"SELECT event_type, n AS event_count, {_pct('n','(SELECT count(*) FROM bronze)',1)} AS percentage FROM (SELECT event_type, count(*) AS n FROM bronze GROUP BY 1)",
            "bronze",
        ),
        "event_profile": bronze(
            "count(*) AS total_records, count(distinct user_id) AS unique_users, count(distinct product_id) AS unique_products"
        ),
        "wow_growth": sales(wow),
        "top_products": products(top_products + "10"),
        "top_products_20": products(top_products + "20"),
        "top_categories": sales(
            f"""SELECT category_level1, category_level2, {_usd('c')} AS revenue, o AS orders, {_mean('c','o')} AS aov FROM (SELECT category_level1, category_level2,
            {SUM_CENTS} AS c, cast(sum(order_count) as bigint) AS o FROM sales GROUP BY 1, 2) ORDER BY c DESC, category_level1, category_level2 LIMIT 10"""
        ),
        "top_champions": rfm(
            """SELECT user_id, customer_segment, rfm_score, monetary, frequency, recency, avg_order_value FROM rfm
            WHERE customer_segment='Champions' ORDER BY cents DESC, user_id LIMIT 20"""
        ),
        "at_risk_customers": rfm(
            """SELECT user_id, customer_segment, monetary, frequency, recency, last_purchase_date FROM rfm
            WHERE customer_segment IN ('At Risk','Cant Lose Them','Can''t Lose Them') ORDER BY cents DESC, user_id LIMIT 50"""
        ),
        "optimisation_candidates": products(
            f"""SELECT product_id, brand, category_level1, views, purchases, purchase_rate, cart_to_purchase_rate FROM performance
            WHERE views > {q.MIN_VIEWS} AND purchase_rate < {q.MAX_PURCHASE_RATE} ORDER BY views DESC, product_id, category_level1, category_level2, brand LIMIT 20"""
        ),
        "brand_performance": products(
            f"""SELECT brand, count(*) AS product_count, cast(sum(purchases) as bigint) AS total_purchases, {_usd(SUM_CENTS)} AS total_revenue,
            {_mean_rate('purchase_rate',4)} AS avg_purchase_rate FROM performance WHERE brand<>'Unknown' GROUP BY brand ORDER BY sum(cents) DESC, brand LIMIT 20"""
        ),
        "funnel_latest_30": funnel(
            """SELECT event_date AS analysis_date, views, carts, purchases, view_to_cart_rate, cart_to_purchase_rate, overall_conversion_rate
            FROM funnel ORDER BY event_date DESC LIMIT 30"""
        ),
        "funnel_stages": _with(
            """SELECT 'Views' AS stage, cast(sum(views) as bigint) AS count FROM counts UNION ALL SELECT 'Carts', cast(sum(carts) as bigint) FROM counts
            UNION ALL SELECT 'Purchases', cast(sum(purchases) as bigint) FROM counts""",
            "counts",
        ),
        # incremental
        "incremental_new_rows": _with(
            f"SELECT {RAW}, _ingestion_time FROM bronze WHERE _ingestion_time > TIMESTAMP '{_first[0]}'", "bronze"
        ),
        "merge_upsert_events": stg_events,
        "incremental_refresh": stg_events,
        "stream_merge_events": _with(f"SELECT {dated} FROM latest", "latest"),
        "stream_dedupe_events": _with(
            f"""SELECT {KEY}, min(_batch_id) AS _batch_id FROM bronze WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY {KEY}""",
            "bronze",
        ),
        "stream_late_events": _with(
            f"""SELECT {KEY}, count(*) AS deliveries
            FROM (SELECT *, event_time >= TIMESTAMP '2024-03-01' AND _batch_id='{_first[1]}' AS newer FROM bronze
                  WHERE user_id IS NOT NULL AND product_id IS NOT NULL)
            GROUP BY {KEY}
            HAVING NOT bool_or(newer) AND event_time <= (SELECT max(event_time) - INTERVAL 10 DAY FROM bronze
                WHERE event_time >= TIMESTAMP '2024-03-01' AND _batch_id='{_first[1]}' AND user_id IS NOT NULL AND product_id IS NOT NULL)""",
            "bronze",
        ),
        "merge_bucketed_events": stg_events,
        "incremental_any_order": stg_events,
        "monthly_customers": silver(
            "event_year::bigint AS sale_year, event_month::bigint AS sale_month, category_level1, count(distinct user_id) AS customers"
        )
        + " WHERE event_type='purchase' GROUP BY GROUPING SETS ((event_year, event_month, category_level1), (event_year, event_month), ())",
        "mv_monthly_sales_changed": sales(
            """SELECT strftime(event_date, '%Y-%m') AS month, category_level1, count(*) AS n_rows,
            cast(sum(order_count) as bigint) AS order_count, cast(sum(unique_customers) as bigint) AS unique_customers,
            cast(sum(cents) as bigint) AS revenue_cents, min(order_count) AS least_order_count, max(order_count) AS most_order_count,
            cast(min(cents) as bigint) AS least_revenue_cents, cast(max(cents) as bigint) AS most_revenue_cents
            FROM sales WHERE category_level1 <> 'economy' GROUP BY 1, 2"""
        ),
        "mv_segment_summary_changed": rfm(
            """SELECT customer_segment, count(*) AS n_rows, cast(sum(cents) as bigint) AS monetary_cents,
            cast(sum(recency) as bigint) AS recency, cast(sum(frequency) as bigint) AS frequency,
            cast(min(recency) as bigint) AS least_recency, cast(max(recency) as bigint) AS most_recency,
            cast(min(cents) as bigint) AS least_monetary_cents, cast(max(cents) as bigint) AS most_monetary_cents
            FROM rfm WHERE user_id % 5 <> 0 GROUP BY customer_segment"""
        ),
        "rfm_scores_maintained": _with(
            """SELECT user_id, ntile(5) OVER (ORDER BY last_purchase_date, user_id) AS r_score,
            ntile(5) OVER (ORDER BY frequency, user_id) AS f_score, ntile(5) OVER (ORDER BY cents, user_id) AS m_score
            FROM buyers WHERE user_id % 5 <> 0""",
            "buyers",
        ),
        # versions and schema evolution
        "snapshot_branches": _with(
            f"""SELECT made_current_at, snapshot_id, CASE snapshot_id WHEN 1 THEN NULL ELSE 1 END::bigint AS parent_id,
            added_records, snapshot_id <> 2 AS is_current_ancestor
            FROM (SELECT min(_ingestion_time) AS made_current_at, row_number() OVER (ORDER BY _batch_id) AS snapshot_id,
                  count(*) AS added_records FROM v3 GROUP BY _batch_id)""",
            "v3",
        ),
        "rollback_branch_read": _with(f"SELECT {dated}, payment_method FROM v3 WHERE _batch_id <> '{_second[1]}'", "v3"),
        "snapshot_list": _with(
            """SELECT 1::bigint AS snapshot_id, NULL::bigint AS parent_id, 'append' AS operation, cast(a as varchar) AS added_records,
              cast(a as varchar) AS total_records, TIMESTAMP '2024-04-01' AS committed_at FROM n
            UNION ALL SELECT 2, 1, 'append', cast(b as varchar), cast(a+b as varchar), TIMESTAMP '2024-04-02' FROM n
            UNION ALL SELECT 3, 2, 'append', cast(c as varchar), cast(a+b+c as varchar), TIMESTAMP '2024-04-03' FROM n""".replace(
                "FROM n",
                f"""FROM (SELECT (SELECT count(*) FROM bronze WHERE _batch_id='{_first[1]}') AS a,
                (SELECT count(*) FROM bronze WHERE _batch_id='{_second[1]}') AS b, (SELECT count(*) FROM third) AS c)""",
            ),
            "bronze", "third",
        ),
        "asof_version": _with(f"SELECT {dated}, payment_method FROM v3 WHERE _batch_id='{_first[1]}'", "v3"),
        "asof_timestamp": _with(f"SELECT {dated}, payment_method FROM v3 WHERE _ingestion_time <= TIMESTAMP '2024-04-02 12:00:00'", "v3"),
        "snapshot_compare": _with(
            f"""SELECT 'older' AS version, count(*) AS row_count FROM bronze WHERE _batch_id='{_first[1]}'
            UNION ALL SELECT 'current', count(*) FROM v3""",
            "v3",
        ),
        "snapshot_diff": _with(
            f"SELECT {RAW}, _batch_id, 'added' AS change, count(*) AS copies FROM bronze WHERE _batch_id='{_second[1]}' GROUP BY ALL", "bronze"
        ),
        "snapshot_history": """SELECT TIMESTAMP '2024-04-01' + (n-1) * INTERVAL 1 DAY AS made_current_at, n AS snapshot_id,
            nullif(n-1,0) AS parent_id, true AS is_current_ancestor FROM (SELECT unnest([1,2,3]::bigint[]) AS n)""",
        "rollback_read": _with(f"SELECT {dated}, payment_method FROM v3 WHERE _batch_id IN ('{_first[1]}', '{_second[1]}')", "v3"),
        "evolve_add_column": sales(
            f"SELECT event_date, category_level1, category_level2, {_usd('cents')} AS total_revenue, NULL::varchar AS sales_channel FROM sales"
        ),
        "evolve_mixed_read": _with(f"SELECT {RAW}, _batch_id, payment_method FROM v3", "v3"),
        "schema_diff": schema_rows
        + " UNION ALL SELECT 'payment_method', NULL, 'string', 'added'",
        "evolve_columns_by_id": _with(
            f"""SELECT event_time AS happened_at, event_type AS kind, product_id, price AS amount, user_session,
            CASE WHEN _batch_id='{_second[1]}' THEN _batch_id END AS batch FROM bronze""",
            "bronze",
        ),
        "dq_at_write": _with(
            f"""SELECT batch, test, column_name, failures, row_count, failures = 0 AS passed
            FROM (SELECT (_batch_id='{_second[1]}')::int::bigint AS batch, count(DISTINCT ({KEY})) AS row_count,
                    count(DISTINCT ({KEY})) FILTER (WHERE event_type NOT IN ('view','cart','purchase','remove_from_cart')) AS odd
                  FROM bronze WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1),
            LATERAL (SELECT unnest(['not_null','not_null','not_null','accepted_values','unique']) AS test,
                unnest(['event_id','user_id','category_code','event_type','event_id']) AS column_name,
                unnest([0, 0, 0, odd, CASE batch WHEN 0 THEN 0 ELSE row_count END]) AS failures)""",
            "bronze",
        ),
        "dq_accepted_rows": stg_first,
        "schema_change_counts": _with(
            " UNION ALL ".join(
                f"""SELECT '{n}' AS column_name, '{t}' AS old_type, '{t}' AS new_type, 'kept' AS change,
                (SELECT count({c}) FROM bronze) AS old_values, (SELECT count({c}) FROM v3) AS new_values"""
                for n, t in raw_types
                for c in [{"_source_file": "*", "event_date": "event_time", "event_year": "event_time", "event_month": "event_time"}.get(n, n)]
            )
            + " UNION ALL SELECT 'payment_method', NULL, 'string', 'added', NULL, (SELECT count(payment_method) FROM v3)",
            "v3",
        ),
        "schema_version_tag": _with(
            """SELECT event_type, user_id, price, payment_method, CASE WHEN payment_method IS NULL THEN 'Old Data (before schema change)'
            ELSE 'New Data (after schema change)' END AS data_version FROM v3
            ORDER BY payment_method IS NOT NULL, event_time DESC, _ingestion_time DESC, event_type, user_id LIMIT 10""",
            "v3",
        ),
        "evolve_rename_drop_cast": sales(
            f"""SELECT sale_year, sale_month, event_date, category_level1, category_level2, order_count AS orders, unique_customers, unique_products,
            {_usd('cents')} AS total_revenue, {_mean('cents','unique_customers')} AS revenue_per_customer, sale_quarter, sale_week FROM sales"""
        ),
        "partition_stats": silver(
            "event_year, event_month, count(*) AS record_count, 1::bigint AS file_count"
        )
        + " GROUP BY event_year, event_month",
        # data quality
        "dq_unique": _dq("unique"),
        "dq_not_null": _dq("not_null"),
        "dq_accepted_values": _dq("accepted_values"),
        "dq_report": _dq("unique", "not_null", "accepted_values"),
    }
