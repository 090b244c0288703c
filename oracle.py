"""DuckDB statements for the queries of __spark_entry__.py.

They state the topic, silver and gold rules on typed values, without the JSON round trip, so the
encode and parse path is really tested.
"""

ORDER_EVENTS = """
order_raw AS (
  SELECT 'order' AS event_type,
    CASE WHEN l_partkey % 97 <> 0
      THEN 'O' || l_orderkey || '-' || l_linenumber END AS order_id,
    printf('U%05d', o_custkey) AS user_id,
    'S' || l_orderkey AS session_id,
    printf('P%06d', l_partkey) AS product_id,
    p_name AS product_name, p_type AS category,
    CAST(l_quantity AS INTEGER) AS quantity, p_retailprice + 0.00495::DOUBLE AS unit_price,
    CASE WHEN l_suppkey % 50 = 0 THEN 0.0::DOUBLE
      WHEN l_linenumber % 2 = 0 THEN l_extendedprice + 0.004::DOUBLE
      ELSE l_extendedprice END AS total_amount,
    'USD' AS currency,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
      WHEN l_returnflag = 'R' THEN 'refunded'
      WHEN l_returnflag = 'A' OR o_orderstatus = 'F' THEN 'completed'
      WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'cancelled' END AS status,
    CASE l_linenumber % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'cash'
      WHEN 2 THEN 'voucher' ELSE 'invoice' END AS payment_method,
    n_name AS country,
    CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE o_orderdate END AS event_ts,
    CASE WHEN l_partkey % 89 = 0 THEN 'bad-ts' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS ts_text,
    o_orderdate AS record_ts,
    CAST(l_orderkey % 3 AS INTEGER) AS part_no,
    CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CAST(l_quantity AS INTEGER), strftime(l_shipdate, '%Y-%m-%d'))), 1, 15) AS BIGINT) AS off_no,
    l_partkey % 101 = 0 AS broken
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

ORDERS = ORDER_EVENTS + """,
order_valid AS (
  SELECT * REPLACE (round(total_amount, 2) AS total_amount) FROM order_raw
  WHERE NOT broken AND order_id IS NOT NULL AND total_amount > 0 AND status <> 'unknown'
),
so AS (
  SELECT * FROM order_valid
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY part_no, off_no) = 1
)"""

CLICK_EVENTS = """
click_src AS (
  SELECT e.*, r.replay, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events e JOIN (VALUES (0), (1)) r(replay) ON r.replay = 0 OR event_id % 20 = 0
),
click_raw AS (
  SELECT 'click' AS event_type,
    CASE WHEN event_id % 97 <> 0 THEN 'C' || event_id END AS click_id,
    printf('U%05d', user_id) AS user_id,
    'S' || user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
    printf('P%06d', k) AS product_id,
    CASE event_type WHEN 'signup' THEN 'home' WHEN 'error' THEN 'search'
      WHEN 'view' THEN 'product' WHEN 'click' THEN 'category' WHEN 'purchase' THEN 'checkout'
      END AS page,
    CASE k % 6 WHEN 0 THEN 'search' WHEN 1 THEN 'partner' WHEN 2 THEN 'mailing'
      WHEN 3 THEN 'direct' WHEN 4 THEN 'forum' END AS referrer,
    CASE k % 3 WHEN 0 THEN 'laptop' WHEN 1 THEN 'phone' ELSE 'kiosk' END AS device,
    CAST(floor(value * 100) AS INTEGER) - 50 AS duration_ms,
    event_type = 'purchase' AS converted,
    ts AS event_ts, CAST(user_id % 3 AS INTEGER) AS part_no,
    event_id * 2 + replay AS off_no, event_id % 101 = 0 AS broken
  FROM click_src
)"""

CLICKS = CLICK_EVENTS + """,
click_valid AS (
  SELECT * REPLACE (coalesce(referrer, 'direct') AS referrer) FROM click_raw
  WHERE NOT broken AND click_id IS NOT NULL AND duration_ms > 0
),
sc AS (
  SELECT * FROM click_valid
  QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY part_no, off_no) = 1
)"""


def total(x):
    """Sum of amounts that have two decimals, as decimals."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18, 2))) AS DOUBLE)"


def mean(x):
    """Mean of non-negative amounts as decimals, rounded half up to cents."""
    s, n = f"CAST(sum(CAST({x} AS DECIMAL(18, 2))) * 100 AS BIGINT)", f"count({x})"
    return f"((2 * {s} + {n}) // (2 * nullif({n}, 0))) / 100.0::DOUBLE"


SPENT = "CASE WHEN status = 'completed' THEN total_amount END"

DAILY = f"""
daily AS (
  SELECT date_trunc('day', event_ts)::TIMESTAMP AS date, {total('total_amount')} AS revenue,
    count(order_id) AS order_count, count(DISTINCT user_id) AS unique_customers,
    {mean('total_amount')} AS avg_order_value
  FROM so WHERE status = 'completed' GROUP BY 1
)"""

PRODUCTS = f"""
products AS (
  SELECT product_id, product_name, category, count(order_id) AS total_orders,
    {total('total_amount')} AS total_revenue, round(CAST(sum(CAST(unit_price AS DECIMAL(18, 6))) AS DOUBLE) / count(unit_price), 2) AS avg_price,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT user_id) AS unique_buyers
  FROM so WHERE status = 'completed' GROUP BY ALL
)"""

USER_ORDERS = f"""
uo AS (
  SELECT user_id, count(order_id) AS total_orders,
    count(CASE WHEN status = 'completed' THEN 1 END) AS completed_orders,
    count(CASE WHEN status = 'cancelled' THEN 1 END) AS cancelled_orders,
    {total(SPENT)} AS total_spend, {mean(SPENT)} AS avg_order_value,
    max(event_ts) AS last_order_ts, min(event_ts) AS first_order_ts,
    count(DISTINCT product_id) AS unique_products_bought
  FROM so GROUP BY user_id
)"""

USER_CLICKS = """
uc AS (
  SELECT user_id, count(click_id) AS total_clicks,
    count(CASE WHEN converted THEN 1 END) AS converted_clicks,
    count(DISTINCT session_id) AS total_sessions
  FROM sc GROUP BY user_id
)"""

USERS = USER_ORDERS + "," + USER_CLICKS + """,
um AS (
  SELECT *, round(completed_orders / (total_clicks + 1), 4) AS conversion_rate
  FROM uo LEFT JOIN uc USING (user_id)
)"""

FUNNEL = """
fu AS (
  SELECT *, round(conversions / (visits + 1), 4) AS conversion_rate FROM (
    SELECT page, count(click_id) AS visits, count(DISTINCT session_id) AS sessions,
      count(DISTINCT user_id) AS unique_users,
      count(CASE WHEN converted THEN 1 END) AS conversions
    FROM sc GROUP BY page)
)"""

COUNTS = ("total_orders", "completed_orders", "cancelled_orders",
          "unique_products_bought", "total_clicks", "total_sessions")
FEATURES = ("total_orders", "completed_orders", "cancelled_orders", "avg_order_value",
            "unique_products_bought", "total_clicks", "total_sessions")

FEATURE_ROWS = f"""
uf AS (
  SELECT user_id, coalesce(avg_order_value, 0) AS avg_order_value,
    {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTS)},
    CASE WHEN total_spend > 500000 THEN 1 ELSE 0 END AS is_high_value
  FROM um
),
hashed AS (
  SELECT *, CAST('0x' || substr(md5(user_id || '|42'), 1, 8) AS BIGINT) AS h FROM uf
),
split AS (
  SELECT * EXCLUDE (rk, n), rk <= round(0.2 * n) AS is_test,
    (h % 101) / 100.0::DOUBLE AS score, CASE WHEN h % 101 >= 50 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT *, row_number() OVER (PARTITION BY is_high_value ORDER BY h, user_id) AS rk,
          count(*) OVER (PARTITION BY is_high_value) AS n FROM hashed)
)"""


def ctes(*parts):
    return "WITH " + ",".join(parts)


SO = ctes(ORDERS)
SC = ctes(CLICKS)
UM = ctes(ORDERS, CLICKS, USERS)
UF = ctes(ORDERS, CLICKS, USERS, FEATURE_ROWS)

ORDER_COLUMNS = """event_type, order_id, user_id, session_id, product_id, product_name, category,
 quantity, unit_price, total_amount, currency, status, payment_method, country, event_ts"""
CLICK_COLUMNS = """event_type, click_id, user_id, session_id, product_id, 'n/a' AS product_name,
 'n/a' AS category, page, referrer, device, duration_ms, converted, event_ts"""
SEGMENT = """CASE WHEN score > 0 AND score <= 0.33 THEN 'low' WHEN score > 0.33 AND score <= 0.66
 THEN 'medium' WHEN score > 0.66 AND score <= 1 THEN 'high' END"""
CLICK_JSON = """'{"event_type":"click","click_id":' || coalesce('"' || click_id || '"', 'null')
 || ',"user_id":"' || user_id || '","session_id":"' || session_id || '","product_id":"'
 || product_id || '","product_name":"n/a","category":"n/a","page":"' || page || '","referrer":'
 || coalesce('"' || referrer || '"', 'null') || ',"device":"' || device || '","duration_ms":'
 || duration_ms || ',"converted":' || converted || ',"timestamp":"'
 || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"}'"""
ENVELOPES = """
 SELECT order_id AS kafka_key, 'orders' AS topic, part_no, off_no, record_ts AS kafka_timestamp
   FROM order_raw
 UNION ALL SELECT click_id, 'clicks', part_no, off_no, event_ts FROM click_raw"""


def report(label="is_high_value"):
    """Classification report from the four counts."""
    def line(name, hit, wrong, missed):
        return f"""SELECT '{name}' AS class, CASE WHEN {hit}+{wrong}=0 THEN 0 ELSE {hit}/({hit}+{wrong}) END AS precision,
          CASE WHEN {hit}+{missed}=0 THEN 0 ELSE {hit}/({hit}+{missed}) END AS recall,
          CASE WHEN 2*{hit}+{wrong}+{missed}=0 THEN 0 ELSE 2*{hit}/(2*{hit}+{wrong}+{missed}) END AS f1_score,
          {hit}+{missed} AS support FROM cells"""
    names = ("precision", "recall", "f1_score")
    r = ", ".join(f"round({n}, 9) AS {n}" for n in names)
    return f"""{UF}, cells AS (
      SELECT count(*) FILTER ({label}=0 AND prediction=0) AS tn, count(*) FILTER ({label}=0 AND prediction=1) AS fp,
        count(*) FILTER ({label}=1 AND prediction=0) AS fn, count(*) FILTER ({label}=1 AND prediction=1) AS tp FROM split),
    classes AS ({line('normal', 'tn', 'fn', 'fp')} UNION ALL {line('high-value', 'tp', 'fp', 'fn')})
    SELECT class, {r}, support FROM (
      SELECT * FROM classes
      UNION ALL SELECT 'accuracy', NULL, NULL, (tn+tp)/(tn+fp+fn+tp), tn+fp+fn+tp FROM cells
      UNION ALL SELECT 'macro avg', {", ".join(f"avg({n})" for n in names)}, CAST(sum(support) AS BIGINT) FROM classes
      UNION ALL SELECT 'weighted avg', {", ".join(f"sum({n}*support)/sum(support)" for n in names)},
        CAST(sum(support) AS BIGINT) FROM classes)"""


def summary():
    return UF + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean,
          round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM uf"""
        for c in FEATURES)


def scaled():
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in FEATURES)
    values = ", ".join(
        f"round(({c} - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END), 6) + 0.0 AS scaled_{c}"
        for c in FEATURES)
    return f"""{UF}, stats AS (SELECT {stats} FROM split WHERE NOT is_test)
      SELECT user_id, is_test, {values} FROM split, stats"""


AUC = """SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 9) AS auc FROM (
  SELECT score, pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS below
  FROM (SELECT score, count(*) FILTER (is_high_value = 1) AS pos,
          count(*) FILTER (is_high_value = 0) AS neg FROM split GROUP BY score))"""


def snapshot_counts():
    counts = {
        ("silver", "orders"): "so", ("silver", "clicks"): "sc", ("gold", "daily_revenue"): "daily",
        ("gold", "product_metrics"): "products", ("gold", "user_metrics"): "um", ("gold", "funnel"): "fu",
    }
    return ctes(ORDERS, CLICKS, DAILY, PRODUCTS, USERS, FUNNEL) + " " + " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, 0::BIGINT AS version, count(*) AS row_count FROM {cte}"
        for (layer, table), cte in counts.items())


def gold_lines():
    """All rows of the gold tables as text, four digits for doubles."""
    number = lambda c: f"printf('%.4f', {c})"
    time = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    columns = {
        ("daily_revenue", "daily"): [time("date"), number("revenue"), "order_count", "unique_customers", number("avg_order_value")],
        ("product_metrics", "products"): ["product_id", "product_name", "category", "total_orders", number("total_revenue"),
            number("avg_price"), "units_sold", "unique_buyers"],
        ("user_metrics", "um"): ["user_id", "total_orders", "completed_orders", "cancelled_orders", number("total_spend"),
            number("avg_order_value"), time("last_order_ts"), time("first_order_ts"), "unique_products_bought", "total_clicks",
            "converted_clicks", "total_sessions", number("conversion_rate")],
        ("funnel", "fu"): ["page", "visits", "sessions", "unique_users", "conversions", number("conversion_rate")],
    }
    return ctes(ORDERS, CLICKS, DAILY, PRODUCTS, USERS, FUNNEL) + " " + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, " + " || '|' || ".join(f"coalesce(({c})::VARCHAR, '-')" for c in given) + f" AS line FROM {cte}"
        for (table, cte), given in columns.items())


def tree_rows(model):
    return f"""SELECT '{model}' AS model, unnest({[*FEATURES]}) AS feature, true AS is_share, 1.0::DOUBLE AS total,
        true AS learns"""


def bronze_columns(topic_cte, topic, ts):
    return f"""SELECT '{topic}' AS topic, part_no, off_no, {ts} AS kafka_timestamp FROM {topic_cte}"""


def schema_lines():
    """Columns of gold.user_metrics in order."""
    columns = (
        "user_id string, total_orders bigint, completed_orders bigint, cancelled_orders bigint, "
        "total_spend double, avg_order_value double, last_order_ts timestamp, first_order_ts timestamp, "
        "unique_products_bought bigint, total_clicks bigint, converted_clicks bigint, "
        "total_sessions bigint, conversion_rate double, updated_at timestamp"
    ).split(", ")
    filled = lambda c: "count(*)" if c == "updated_at" else f"count({c})"
    return UM + " " + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS data_type, true AS nullable, "
        f"{filled(c.split()[0])} AS filled FROM um"
        for i, c in enumerate(columns))


def statements():
    users_without_clicks = ctes(ORDERS, USER_ORDERS) + """ SELECT *, NULL::BIGINT AS total_clicks,
      NULL::BIGINT AS converted_clicks, NULL::BIGINT AS total_sessions,
      NULL::DOUBLE AS conversion_rate FROM uo"""
    pages = ctes(CLICKS, FUNNEL) + " SELECT * FROM fu"
    orders_back = f"{SO} SELECT order_id, user_id, status, total_amount, event_ts FROM so"
    clicks_raw = ctes(CLICK_EVENTS)
    orders_raw = ctes(ORDER_EVENTS)
    segments = f"""{UF} SELECT s.segment, count(x.user_id) AS users
      FROM (VALUES ('low'), ('medium'), ('high')) s(segment)
      LEFT JOIN (SELECT user_id, {SEGMENT} AS segment FROM split) x USING (segment) GROUP BY 1"""
    return {
        # sources
        "stream_scan": clicks_raw + " " + bronze_columns("click_raw", "clicks", "event_ts"),
        "table_scan": orders_back,
        "version_scan": SO + """ SELECT version, row_count, revenue FROM (
            SELECT v::BIGINT AS version, count(*) AS row_count, CAST(sum(CAST(round(total_amount * 100) AS BIGINT))
              AS BIGINT) / 100.0::DOUBLE AS revenue
            FROM so JOIN (VALUES (0, 'completed'), (1, 'refunded')) t(v, st) ON st = status GROUP BY v)""",
        "optional_scan": users_without_clicks,
        "table_history": SO + """ SELECT CASE status WHEN 'completed' THEN 0 ELSE 1 END::BIGINT AS version,
            true AS dated, 'WRITE' AS operation, 'Overwrite' AS mode, count(*) AS row_count FROM so
            WHERE status IN ('completed', 'refunded') GROUP BY status""",
        "version_scan_bronze": clicks_raw + """, versions AS (SELECT v::BIGINT AS version, c.* FROM click_raw c JOIN (VALUES (0), (1)) t(v) ON off_no % 2 <= v)
            SELECT part_no, version, count(*) AS row_count, sum(count(*)) OVER (PARTITION BY version)::BIGINT AS in_view,
              min(off_no)::BIGINT AS first_offset, max(off_no)::BIGINT AS last_offset, sum(off_no)::BIGINT AS offsets
            FROM versions GROUP BY part_no, version""",
        "table_history_bronze": clicks_raw + """ SELECT (off_no % 2)::BIGINT AS version, 'STREAMING UPDATE' AS operation, 'main' AS stream,
            true AS dated, count(*) AS row_count, true AS has_files FROM click_raw GROUP BY off_no % 2""",
        "describe_schema": schema_lines(),
        "named_table_sql": ctes(CLICKS, FUNNEL) + " SELECT page, visits, conversion_rate FROM fu WHERE visits > 0",
        # sinks and encoding
        "bronze_append": f"""{clicks_raw} SELECT 'clicks' AS topic, part_no, off_no, event_ts AS kafka_timestamp,
            click_id AS kafka_key, sha256(CASE WHEN broken THEN '{{"broken' ELSE {CLICK_JSON} END) AS payload_sha256 FROM click_raw""",
        "snapshot_overwrite": SO + " SELECT order_id, user_id, total_amount FROM so WHERE status = 'completed'",
        "stream_row_counts": ctes(ORDER_EVENTS, CLICK_EVENTS) + """, judged AS (
              SELECT 'orders' AS topic, order_id AS id, CASE WHEN broken OR order_id IS NULL THEN 1 WHEN NOT coalesce(total_amount > 0, false) THEN 2
                WHEN NOT coalesce(status <> 'unknown', false) THEN 3 ELSE 0 END AS rule FROM order_raw
              UNION ALL SELECT 'clicks', click_id, CASE WHEN broken OR click_id IS NULL THEN 1 WHEN NOT coalesce(duration_ms > 0, false) THEN 2 ELSE 0 END FROM click_raw)
            SELECT topic, count(*) AS bronze_read, count(*) AS bronze_written, count(*) AS silver_read, count(*) FILTER (rule = 1) AS no_id,
              count(*) FILTER (rule = 2) AS not_positive, count(*) FILTER (rule = 3) AS unknown_status,
              count(*) FILTER (rule = 0) - count(DISTINCT id) FILTER (rule = 0) AS copies, count(DISTINCT id) FILTER (rule = 0) AS silver_written
            FROM judged GROUP BY topic""",
        "bronze_compaction": clicks_raw + """ SELECT 'clicks' AS topic, part_no, count(*) * CASE part_no WHEN 0 THEN 2 ELSE 1 END AS row_count,
            count(DISTINCT off_no) AS offsets, min(off_no)::BIGINT AS first_offset, max(off_no)::BIGINT AS last_offset FROM click_raw GROUP BY part_no""",
        "late_dates": ctes(ORDERS, DAILY) + " SELECT * FROM daily",
        "write_row_count": SO + " SELECT 'silver' AS layer, 'orders' AS table_name, 0::BIGINT AS version, count(*) AS row_count FROM so",
        "event_encode": f"""{clicks_raw} SELECT click_id AS key_text, {CLICK_JSON} AS value_text,
            'clicks' AS topic, part_no, off_no FROM click_raw""",
        "topic_route": ctes(ORDER_EVENTS, CLICK_EVENTS) + """
            SELECT 'orders' AS topic, order_id AS key_text, 'order' AS event_type FROM order_raw
            UNION ALL SELECT 'clicks', click_id, 'click' FROM click_raw""",
        # projections and filters
        "envelope_project": ctes(ORDER_EVENTS, CLICK_EVENTS) + ENVELOPES,
        "json_parse_flatten": f"""{orders_raw} SELECT part_no, off_no,
            {", ".join(f"CASE WHEN NOT broken THEN {c} END AS {c}" for c in (
                "event_type", "order_id", "user_id", "session_id", "product_id", "product_name", "category",
                "quantity", "unit_price", "total_amount", "currency", "status", "payment_method", "country"))}
            FROM order_raw""",
        "filter_not_null": orders_raw + " SELECT part_no, off_no, order_id FROM order_raw WHERE NOT broken AND order_id IS NOT NULL",
        "filter_positive": clicks_raw + " SELECT part_no, off_no, duration_ms FROM click_raw WHERE NOT broken AND duration_ms > 0",
        "filter_positive_amount": orders_raw + " SELECT part_no, off_no, total_amount FROM order_raw WHERE NOT broken AND total_amount > 0",
        "filter_in_list": orders_raw + """ SELECT part_no, off_no, status FROM order_raw WHERE NOT broken
            AND status IN ('completed', 'pending', 'cancelled', 'refunded')""",
        "filter_equals": SO + " SELECT order_id, status, total_amount FROM so WHERE status = 'completed'",
        "derive_columns": clicks_raw + """ SELECT off_no, part_no, click_id, event_ts, coalesce(referrer, 'direct') AS referrer
            FROM click_raw WHERE NOT broken""",
        "select_columns": SC + " SELECT click_id, user_id, page, duration_ms FROM sc",
        # joins
        "user_left_join": UM + " SELECT user_id, completed_orders, total_clicks, converted_clicks, total_sessions FROM um",
        "user_metrics_no_clicks": users_without_clicks,
        # aggregations
        "dedup_orders": SO + " SELECT order_id, part_no, off_no, total_amount FROM so",
        "dedup_clicks": SC + " SELECT click_id, part_no, off_no, duration_ms FROM sc",
        "daily_revenue": ctes(ORDERS, DAILY) + " SELECT * FROM daily",
        "product_metrics": ctes(ORDERS, PRODUCTS) + " SELECT * FROM products",
        "user_orders": ctes(ORDERS, USER_ORDERS) + " SELECT * FROM uo",
        "user_clicks": ctes(CLICKS, USER_CLICKS) + " SELECT * FROM uc",
        "user_metrics": UM + " SELECT * FROM um",
        "funnel": pages,
        "status_distribution": SO + " SELECT status, count(*) AS count FROM so GROUP BY status",
        "category_revenue": f"""{SO} SELECT category, count(order_id) AS orders, {total('total_amount')} AS revenue,
            {total('total_amount')} / count(total_amount) AS avg_value FROM so WHERE status = 'completed' GROUP BY category""",
        "row_count": SO + " SELECT count(*) AS row_count FROM so",
        "agg_count_distinct": SO + """ SELECT count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
            count(DISTINCT event_ts) AS instants FROM so""",
        "distinct_by_bitmap": SO + """ SELECT count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products,
            count(DISTINCT event_ts) AS instants FROM so""",
        "funnel_by_bitmap": pages,
        "agg_conditional": f"""{SO} SELECT category, count(CASE WHEN status = 'completed' THEN 1 END) AS completed,
            count(CASE WHEN status = 'cancelled' THEN 1 END) AS cancelled, {total(SPENT)} AS spend, {mean(SPENT)} AS mean_spend
            FROM so GROUP BY category""",
        "agg_min_max_ts": SO + " SELECT user_id, min(event_ts) AS first_ts, max(event_ts) AS last_ts FROM so GROUP BY user_id",
        "feature_summary": summary(),
        # sorts and top-k
        "latest_days_top10": ctes(ORDERS, DAILY) + " SELECT * FROM daily ORDER BY date DESC NULLS LAST LIMIT 10",
        "latest_days_pruned": ctes(ORDERS, DAILY) + " SELECT * FROM daily WHERE date IS NOT NULL ORDER BY date DESC LIMIT 10",
        "revenue_by_date": ctes(ORDERS, DAILY) + " SELECT * FROM daily WHERE date BETWEEN '1996-03-15' AND '1999-12-31'",
        "top_products": ctes(ORDERS, PRODUCTS) + """ SELECT * FROM products
            ORDER BY total_revenue DESC NULLS LAST, product_id, product_name, category LIMIT 10""",
        "top_users": UM + " SELECT * FROM um ORDER BY total_spend DESC NULLS LAST, user_id LIMIT 10",
        "funnel_by_visits": pages + " ORDER BY visits DESC, page",
        "revenue_series": ctes(ORDERS, DAILY) + " SELECT date, revenue, order_count FROM daily ORDER BY date",
        "limit_n": SO + " SELECT order_id, user_id, status, total_amount FROM so ORDER BY order_id LIMIT 5",
        # scalar functions
        "scalar_json_parse": clicks_raw + """ SELECT off_no, CASE WHEN NOT broken THEN duration_ms END AS duration_ms,
            CASE WHEN NOT broken THEN converted END AS converted, CASE WHEN NOT broken THEN page END AS page FROM click_raw""",
        "scalar_to_timestamp": orders_raw + " SELECT off_no, CASE WHEN NOT broken THEN event_ts END AS event_ts FROM order_raw",
        "scalar_day_trunc": clicks_raw + " SELECT off_no, date_trunc('day', event_ts)::TIMESTAMP AS day FROM click_raw",
        "scalar_round": orders_raw + " SELECT off_no, round(total_amount, 2) AS amount, round(quantity / (part_no + 1), 4) AS ratio FROM order_raw",
        "scalar_case": SO + f""" SELECT order_id, CASE WHEN status = 'completed' THEN 1 ELSE 0 END AS is_completed,
            {SPENT} AS spent FROM so""",
        "scalar_coalesce": clicks_raw + " SELECT off_no, coalesce(referrer, 'direct') AS referrer FROM click_raw",
        "scalar_fillna": UM + """ SELECT user_id, last_order_ts, coalesce(total_clicks, 0) AS total_clicks,
            coalesce(total_spend, 0) AS total_spend, coalesce(conversion_rate, 0) AS conversion_rate FROM um""",
        "scalar_cast": UM + """ SELECT user_id, CAST(total_orders AS INTEGER) AS total_orders, CAST(total_clicks AS INTEGER)
            AS total_clicks, CAST(unique_products_bought AS DOUBLE) AS products, CAST(completed_orders AS VARCHAR) AS completed_text FROM um""",
        "scalar_ratio": UM + " SELECT user_id, round(completed_orders / (total_clicks + 1), 4) AS ratio FROM um",
        "scalar_predicates": clicks_raw + """ SELECT off_no, click_id IS NULL AS no_id, duration_ms > 0 AS positive,
            referrer = 'search' AS from_search, referrer IN ('mailing', 'direct') AS own, NOT (referrer IS NULL) AS known FROM click_raw""",
        "scalar_json_encode": f"{clicks_raw} SELECT off_no, {CLICK_JSON} AS payload FROM click_raw",
        "scalar_iso_format": clicks_raw + """ SELECT off_no, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS text FROM click_raw""",
        "scalar_padded_id": """SELECT l_orderkey, l_linenumber, printf('P%04d', l_partkey) AS product_id,
            printf('U%05d', l_suppkey) AS user_id FROM lineitem""",
        "scalar_segment": f"{UF} SELECT user_id, score, {SEGMENT} AS segment FROM split",
        # features and evaluation
        "user_features": UF + " SELECT * FROM uf",
        "class_balance": UF + " SELECT round(avg(is_high_value), 9) AS positive_share FROM uf",
        "stratified_split": UF + " SELECT user_id, is_high_value, is_test FROM split",
        "split_sizes": UF + " SELECT is_test, count(*) AS rows FROM split GROUP BY is_test",
        "standard_scale": scaled(),
        "roc_auc": f"{UF} {AUC}",
        "classification_report": report(),
        "confusion_matrix": UF + """ SELECT a.v AS actual, p.v AS predicted, count(s.user_id) AS rows
            FROM (VALUES (0), (1)) a(v) JOIN (VALUES (0), (1)) p(v) ON true
            LEFT JOIN split s ON s.is_high_value = a.v AND s.prediction = p.v GROUP BY ALL""",
        "segment_distribution": segments,
        "score_histogram": UF + """, span AS (SELECT min(score) AS lo, max(score) AS hi FROM split)
            SELECT b.bin::INTEGER AS bin, count(x.bin) AS rows FROM range(40) b(bin)
            LEFT JOIN (SELECT least(floor((score - lo) / (hi - lo) * 40), 39) AS bin FROM split, span) x ON x.bin = b.bin GROUP BY 1""",
        # streaming
        "stream_two_topics": ctes(ORDER_EVENTS, CLICK_EVENTS) + """
            SELECT topic, part_no, count(*) AS row_count, CAST(min(off_no) AS BIGINT) AS first_offset,
              CAST(max(off_no) AS BIGINT) AS last_offset FROM (SELECT 'orders' AS topic, part_no, off_no FROM order_raw
              UNION ALL SELECT 'clicks', part_no, off_no FROM click_raw) GROUP BY ALL""",
        "stream_resume": clicks_raw + " SELECT part_no, count(*) AS row_count, count(DISTINCT off_no) AS offsets FROM click_raw GROUP BY part_no",
        "stream_replay_dedup": f"{SC} SELECT {CLICK_COLUMNS} FROM sc",
        # jobs
        "silver_orders": f"{SO} SELECT {ORDER_COLUMNS}, ts_text, NULL::VARCHAR AS kafka_key FROM so",
        "silver_clicks": f"""{SC} SELECT {CLICK_COLUMNS}, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_text FROM sc""",
        "silver_incremental": f"{SC} SELECT {CLICK_COLUMNS} FROM sc",
        "gold_refresh": gold_lines(),
        "gold_incremental": gold_lines(),
        "run_once": snapshot_counts(),
        # models: what holds for the fitted ones
        "logistic_regression": f"SELECT unnest({[*FEATURES, 'intercept']}) AS weight, 0.0::DOUBLE AS gradient",
        "random_forest": tree_rows("Random Forest"),
        "gradient_boosting": tree_rows("Gradient Boosting"),
        "tree_scores": UF + """ SELECT model, user_id, true AS is_same, true AS is_likelier, true AS is_binned
            FROM uf, (VALUES ('Random Forest'), ('Gradient Boosting')) m(model)""",
        "tree_importances": f"""SELECT model, feature, true AS is_same, true AS same_place
            FROM (SELECT unnest({[*FEATURES]}) AS feature), (VALUES ('Random Forest'), ('Gradient Boosting')) m(model)""",
        "best_model": """SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS model,
            true AS learns, true AS best_is_no_worse""",
        "predict_proba": UF + " SELECT user_id, true AS is_probability, true AS is_same FROM split WHERE is_test",
        "predict_class": UF + " SELECT user_id, is_high_value, true AS is_likelier FROM split WHERE is_test",
        "score_all_users": UF + " SELECT user_id, true AS is_binned FROM uf",
        "top_propensity": UF + " SELECT CAST(row_number() OVER (ORDER BY user_id) AS INTEGER) AS place, 0::BIGINT AS higher_outside FROM (SELECT user_id FROM uf LIMIT 10)",
        "feature_importance": f"SELECT unnest({[*FEATURES]}) AS feature, true AS is_number",
        "propensity": UF + """, sizes AS (SELECT count(*) AS n, count(*) FILTER (is_test) AS t FROM split)
            SELECT r.result, CASE r.k WHEN 0 THEN 0 WHEN 1 THEN t ELSE n END::BIGINT AS users FROM sizes, (VALUES ('scored', 2),
            ('tested', 1), ('report', 1), ('matrix', 1), ('importances', 0), ('segments', 2), ('histogram', 2)) r(result, k)""",
    }
