"""The same results in DuckDB SQL, written independently of the Spark plans.

DuckDB divides decimals as doubles, so means and ratios are built from integers: for a, b >= 0 the value
a / b rounded half up is (2a + b) // 2b.
"""

from __future__ import annotations

# Values of its own, so that a slip in the code under test does not pass on both sides.
AS_OF, EARLIER_AS_OF, FIRST_SIGNUP = "2001-08-01", "2001-02-01", "1994-10-03"
RELOAD_FROM, LOADED_UNTIL, RELOAD_SHIPPING = "1999-01-01", "2000-01-01", "5.00"
FEATURE_TYPES = {
    "total_orders": "int",
    "total_revenue": "decimal(14,2)",
    "avg_order_value": "decimal(14,2)",
    "avg_basket_size": "decimal(14,2)",
    "purchase_frequency_per_mo": "decimal(14,4)",
    "days_since_last_purchase": "int",
    "returns_rate": "decimal(10,4)",
}
COLUMNS = list(FEATURE_TYPES)
CENTERS = [
    [-1.0, -1.0, -0.5, -0.5, -0.5, 1.0, 0.0],
    [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.0, 1.0, 0.5, 0.0, 0.5, -0.5, -0.5],
    [0.0, -0.5, 0.0, 0.5, 0.0, 0.0, 1.0],
]


def _rounded(numerator: str, denominator: str, digits: int, type_: str) -> str:
    scaled = f"(2 * ({numerator})::hugeint * {10**digits} + ({denominator})) // (2 * nullif(({denominator}), 0))"
    return f"(({scaled})::decimal(20,0) * {10**-digits:.{digits}f})::{type_}"


def _cents(amount: str) -> str:
    return f"(({amount}) * 100)::hugeint"


def _money_mean(amount_sum: str, count: str) -> str:
    cents = f"(2 * {_cents(amount_sum)} + ({count})) // (2 * nullif(({count}), 0))"
    return f"(({cents})::decimal(20,0) * 0.01)::decimal(14,2)"


def _base_as_of(day: str) -> str:
    return f"""
        SELECT customer_id, (DATE '{day}' - max(order_date))::int AS recency_days,
               count(DISTINCT order_id)::int AS frequency_orders, sum(order_total)::decimal(14,2) AS monetary_value
        FROM done WHERE order_date >= DATE '{day}' - 365 GROUP BY customer_id"""


def _faulty_lines(source: str) -> str:
    return f"""
        SELECT CASE WHEN order_item_id % 101 <> 0 THEN order_item_id END AS order_item_id, order_id, product_id,
               CASE WHEN product_id % 79 = 0 THEN 0 ELSE quantity END AS quantity, unit_price,
               CASE WHEN product_id % 5 = 0 THEN 0 ELSE line_total END AS line_total
        FROM {source}"""


_CTES = {
    "r_customers": f"""
        SELECT c_custkey::int AS customer_id,
               (DATE '{FIRST_SIGNUP}' + (c_custkey % 365)::int)::date AS signup_date,
               n_name AS country, c_mktsegment AS channel,
               'd' || (c_custkey % 4)::varchar || '.example' AS email_domain,
               c_acctbal >= 0 AS is_active
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "r_products": """
        SELECT p_partkey::int AS product_id, p_type AS category, p_brand AS brand,
               p_retailprice::decimal(10,2) AS unit_cost
        FROM part""",
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey::int AS customer_id, o_orderdate::date AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'returned' WHEN 'P' THEN 'cancelled' END AS status,
               o_orderpriority AS payment_type, o_totalprice::decimal(12,2) AS order_total,
               coalesce(discount, 0)::decimal(12,2) AS discount_total, 0::decimal(12,2) AS shipping_total
        FROM orders LEFT JOIN (
            SELECT l_orderkey, sum(l_extendedprice::decimal(12,2) * l_discount::decimal(4,2)) AS discount
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "r_items": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                  l_extendedprice, l_quantity) AS order_item_id,
               l_orderkey AS order_id, l_partkey::int AS product_id, l_quantity::int AS quantity,
               (((l_extendedprice::decimal(12,2) * 100)::bigint // l_quantity::int)::decimal(14,0) * 0.01)::decimal(12,2)
                   AS unit_price,
               l_extendedprice::decimal(12,2) AS line_total
        FROM lineitem""",
    "f_customers": """
        SELECT CASE WHEN customer_id % 61 <> 0 THEN customer_id END AS customer_id, signup_date,
               CASE WHEN customer_id % 3 = 0 THEN 'US' ELSE country END AS country,
               CASE WHEN customer_id % 5 = 0 THEN 'web' ELSE channel END AS channel,
               CASE WHEN customer_id % 7 = 0 THEN 'proton.me' ELSE email_domain END AS email_domain
        FROM (SELECT * FROM r_customers UNION ALL SELECT * FROM r_customers WHERE customer_id % 50 = 0)""",
    "f_products": """
        SELECT product_id, CASE WHEN product_id % 2 = 0 THEN 'Home' ELSE category END AS category,
               CASE WHEN product_id % 3 = 0 THEN 'Nova' ELSE brand END AS brand
        FROM (SELECT * FROM r_products UNION ALL SELECT * FROM r_products WHERE product_id % 40 = 0)
        WHERE product_id % 71 <> 0""",
    "f_orders": """
        SELECT CASE WHEN order_id % 97 <> 0 THEN order_id END AS order_id, customer_id, order_date,
               CASE WHEN order_id % 67 = 0 THEN 'lost' ELSE status END AS status,
               CASE WHEN order_id % 4 = 0 THEN 'card' ELSE payment_type END AS payment_type,
               CASE WHEN status = 'cancelled' AND order_id % 2 = 0 THEN 0
                    WHEN order_id % 83 = 0 THEN -order_total ELSE order_total END AS order_total,
               CASE WHEN status = 'cancelled' AND order_id % 2 = 0 THEN 0
                    WHEN order_id % 83 = 0 THEN -discount_total ELSE discount_total END AS discount_total, shipping_total
        FROM (SELECT * FROM r_orders UNION ALL SELECT * FROM r_orders WHERE order_id % 90 = 0) WHERE order_id % 89 <> 0""",
    "f_items": _faulty_lines("r_items"),
    "f_items_twice": _faulty_lines("(SELECT * FROM r_items UNION ALL SELECT * FROM r_items WHERE order_item_id % 100 = 0)"),
    "f_dates": "SELECT * FROM dates WHERE day <> 13",
    "dates": """
        SELECT DISTINCT order_date AS date_key, year(order_date)::int AS year, month(order_date)::int AS month,
               day(order_date)::int AS day, weekofyear(order_date)::int AS week,
               rpad(strftime(order_date, '%A'), 9, ' ') AS day_name,
               rpad(strftime(order_date, '%B'), 9, ' ') AS month_name
        FROM r_orders WHERE order_date IS NOT NULL""",
    "reload": f"""
        SELECT * REPLACE ((order_total + {RELOAD_SHIPPING})::decimal(12,2) AS order_total,
                          {RELOAD_SHIPPING}::decimal(12,2) AS shipping_total)
        FROM r_orders WHERE order_date >= DATE '{RELOAD_FROM}'""",
    "kept": "SELECT * FROM r_orders WHERE status IN ('completed', 'returned')",
    "done": "SELECT * FROM r_orders WHERE status = 'completed'",
    "clean": """
        SELECT i.*, k.customer_id FROM r_items i JOIN kept k ON i.order_id = k.order_id
        WHERE i.quantity > 0 AND i.unit_price >= 0""",
    # Everything about a customer's orders in one aggregate; an order without a counted line has no basket.
    "behaviour": """
        SELECT customer_id, min(order_date) AS first_day, max(order_date) AS last_day, age(max(order_date), min(order_date)) AS span,
               count(DISTINCT order_id) AS n_orders, count(*) AS n_kept, count(*) FILTER (status = 'returned') AS n_returned,
               sum(order_total) FILTER (status = 'completed') AS paid, count(order_total) FILTER (status = 'completed') AS n_paid,
               sum(units) AS units, count(units) AS n_baskets
        FROM kept LEFT JOIN (SELECT order_id, sum(quantity) AS units FROM r_items WHERE quantity > 0 AND unit_price >= 0 GROUP BY order_id)
             USING (order_id)
        GROUP BY customer_id""",
    "spent": """
        SELECT customer_id, category, sum(line_total)::decimal(22,2) AS cat_revenue
        FROM clean JOIN r_products USING (product_id) GROUP BY ALL""",
    "favourite": """
        SELECT customer_id, arg_min(category, (cat_revenue IS NOT NULL, -cat_revenue, category)) AS dominant_category
        FROM spent GROUP BY customer_id""",
    "measures": f"""
        SELECT customer_id, first_day, last_day, n_orders::int AS n_orders, paid::decimal(14,2) AS paid, n_baskets,
               {_money_mean('paid', 'n_paid')} AS mean_paid,
               {_rounded('units', 'n_baskets', 2, 'decimal(14,2)')} AS mean_basket,
               {_rounded('n_returned', 'n_kept', 4, 'decimal(10,4)')} AS share_returned,
               {_rounded('n_orders', 'nullif(greatest(extract(month FROM span), 1), 1)', 4, 'decimal(14,4)')} AS monthly,
               {_rounded('n_orders', 'greatest(extract(year FROM span) * 12 + extract(month FROM span), 1)', 4, 'decimal(14,4)')}
                   AS monthly_strict
        FROM behaviour""",
    "metrics": f"""
        SELECT customer_id, first_day AS first_purchase_date, last_day AS last_purchase_date, coalesce(n_orders, 0)::int AS total_orders,
               coalesce(paid, 0)::decimal(14,2) AS total_revenue, coalesce(mean_paid, 0)::decimal(14,2) AS avg_order_value,
               coalesce(mean_basket, 0)::decimal(14,2) AS avg_basket_size, coalesce(monthly, 0)::decimal(14,4) AS purchase_frequency_per_mo,
               (DATE '{AS_OF}' - last_day)::int AS days_since_last_purchase, coalesce(share_returned, 0)::decimal(10,4) AS returns_rate,
               dominant_category
        FROM (SELECT customer_id FROM r_customers) LEFT JOIN measures USING (customer_id) LEFT JOIN favourite USING (customer_id)""",
    "rfm": _base_as_of(AS_OF),
    "rfm_earlier": _base_as_of(EARLIER_AS_OF),
    "ranked": """
        SELECT *, count(*) OVER () AS n,
               row_number() OVER (ORDER BY recency_days, customer_id) AS rr,
               row_number() OVER (ORDER BY frequency_orders, customer_id) AS fr,
               row_number() OVER (ORDER BY monetary_value, customer_id) AS mr
        FROM rfm""",
    "scores": """
        SELECT customer_id, recency_days, frequency_orders, monetary_value,
               (6 - greatest(1, (5 * (rr - 1) + n - 2) // (n - 1)))::int AS r_score,
               greatest(1, (5 * (fr - 1) + n - 2) // (n - 1))::int AS f_score,
               greatest(1, (5 * (mr - 1) + n - 2) // (n - 1))::int AS m_score
        FROM ranked""",
    "segmented": """
        SELECT *, (r_score * 100 + f_score * 10 + m_score)::int AS rfm_score,
               CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                    WHEN r_score >= 4 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal'
                    WHEN r_score >= 3 AND m_score >= 4 THEN 'Big Spenders'
                    WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
                    WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN 'At Risk'
                    WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Hibernating'
                    ELSE 'Needs Attention' END AS segment
        FROM scores""",
    "visits": """
        SELECT customer_id, month, min(month) OVER (PARTITION BY customer_id) AS joined
        FROM (SELECT DISTINCT customer_id, datetrunc('month', order_date)::date AS month FROM done)""",
    "retention": f"""
        SELECT joined AS cohort_month, month AS active_month, starters::int AS cohort_size, visitors::int AS active_users,
               {_rounded('visitors', 'starters', 4, 'decimal(10,4)')} AS retention_rate
        FROM (SELECT joined, month, count(*) AS visitors,
                     first_value(count(*)) OVER (PARTITION BY joined ORDER BY month) AS starters
              FROM visits GROUP BY joined, month)""",
    "features": "SELECT customer_id, "
    + ", ".join(
        f"coalesce({c}, {9999 if c == 'days_since_last_purchase' else 0})::{kind} AS {c}" for c, kind in FEATURE_TYPES.items()
    )
    + " FROM metrics",
    "z": "SELECT f.*, "
    + ", ".join(
        f"round_even((({c}::double) - avg({c}::double) OVER ()) / coalesce(nullif(stddev_pop({c}::double) OVER (), 0), 1)"
        f" * 1048576, 0) / 1048576 AS z_{c}"
        for c in COLUMNS
    )
    + " FROM features f",
    "distances": "SELECT *, ["
    + ", ".join("+".join(f"(z_{c} - {x}) * (z_{c} - {x})" for c, x in zip(COLUMNS, center)) for center in CENTERS)
    + "] AS d FROM z",
    "clusters": "SELECT customer_id, (list_position(d, list_min(d)) - 1)::int AS cluster_id, "
    + ", ".join(COLUMNS)
    + " FROM distances",
}



def _gap(a: str, b: str) -> str:
    return " + ".join(f"({a}.z_{c} - {b}.z_{c}) * ({a}.z_{c} - {b}.z_{c})" for c in COLUMNS)


def _labels(sets: dict[int, list[list[float]]]) -> str:
    """(k, cl, customer_id, z...) for every set of centres."""
    one = []
    for k, centers in sets.items():
        gaps = ", ".join(" + ".join(f"(z_{c} - {x!r}) * (z_{c} - {x!r})" for c, x in zip(COLUMNS, center)) for center in centers)
        one.append(f"SELECT {k} AS k, list_position([{gaps}], list_min([{gaps}])) AS cl, z.* FROM z")
    return " UNION ALL ".join(one)


def _silhouette(labels: str) -> str:
    """(k, silhouette) of labelled customers, by comparing all pairs."""
    return f"""
        l AS MATERIALIZED ({labels}),
        means AS (SELECT a.k, a.customer_id, a.cl = b.cl AS own, b.cl, sum({_gap("a", "b")}) AS total, count(*) AS n
                  FROM l a JOIN l b ON a.k = b.k GROUP BY a.k, a.customer_id, a.cl, b.cl),
        sides AS (SELECT k, customer_id, max(n) FILTER (own) AS n,
                         max(total / greatest(n - 1, 1)) FILTER (own) AS inside, min(total / n) FILTER (NOT own) AS outside
                  FROM means GROUP BY k, customer_id),
        scores AS (SELECT k, avg(CASE WHEN n > 1 AND greatest(inside, outside) > 0
                                      THEN (outside - inside) / greatest(inside, outside) ELSE 0 END) AS silhouette
                   FROM sides GROUP BY k)"""


def _lloyd(steps: int) -> str:
    """`steps` rounds, each a table of centres c0, c1, ... and the last one's customers."""
    start = " UNION ALL ".join(f"SELECT {i} AS cl, " + ", ".join(f"{x!r}::double AS z_{c}" for c, x in zip(COLUMNS, row)) for i, row in enumerate(CENTERS))
    parts = [f"c0 AS ({start})"]
    for i in range(steps + 1):
        parts.append(
            f"n{i} AS (SELECT z.*, (SELECT arg_min(cl, ({_gap('z', 'c')}, cl)) FROM c{i} c) AS cl FROM z)"
        )
        if i < steps:
            means = ", ".join(f"coalesce(avg(n.z_{c}), any_value(c.z_{c})) AS z_{c}" for c in COLUMNS)
            parts.append(f"c{i + 1} AS (SELECT c.cl, {means} FROM c{i} c LEFT JOIN n{i} n ON n.cl = c.cl GROUP BY c.cl)")
    return ",\n".join(parts)


def _distance(a: str, b: str) -> str:
    """Squared distance of two lists of coordinates."""
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, len(COLUMNS) + 1))


def _fits(most: int) -> str:
    """(k, cs): the centres of every fit from 3 to `most`, from the drawn seeds until they stand still."""
    parts = [f"points AS MATERIALIZED (SELECT customer_id, [{', '.join(f'z_{c}' for c in COLUMNS)}] AS p FROM z)"]
    for n in range(most):  # the draw: least -ln(u) / distance from the seeds before, with u the md5 of id, 42 and round
        near = _distance("p", "c")
        gap = "1.0::DOUBLE" if n == 0 else near if n == 1 else f"least(d, {near})"
        source = "points" if n == 0 else f"points CROSS JOIN seed{n - 1}" if n == 1 else f"gap{n - 1} CROSS JOIN seed{n - 1}"
        parts.append(f"gap{n} AS MATERIALIZED (SELECT customer_id, p, {gap} AS d FROM {source})")
        u = f"(('0x' || md5(customer_id || ':42:{n}')[1:12])::bigint + 1) / {2**48 + 1}.0"
        parts.append(f"seed{n} AS MATERIALIZED (SELECT arg_min(p, (-ln({u}) / d, customer_id)) AS c FROM gap{n} WHERE d > 0)")
    seeds = ", ".join(f"(SELECT c FROM seed{n})" for n in range(most))
    means = ", ".join(f"sum((p[{i}] * 1048576)::bigint)::double / count(*) / 1048576" for i in range(1, len(COLUMNS) + 1))
    gaps = f"list_transform(f.cs, lambda c: {_distance('p', 'c')})"
    parts.append(
        f"""fit AS (
            SELECT k, 0 AS step, [{seeds}][1:k] AS cs, true AS moving FROM range(3, {most + 1}) ks(k)
            UNION ALL
            SELECT k, step + 1, cs, moved > 1e-4 FROM (
                SELECT k, any_value(step) AS step, list(c ORDER BY i) AS cs, sum({_distance('c', 'old')}) AS moved FROM (
                    SELECT o.k, o.step, o.i, o.old, coalesce(n.c, o.old) AS c
                    FROM (SELECT k, step, unnest(range(1, k + 1)) AS i, unnest(cs) AS old FROM fit WHERE moving AND step < 300) o
                    LEFT JOIN (SELECT k, i, [{means}] AS c
                               FROM (SELECT f.k, p, list_position({gaps}, list_min({gaps})) AS i
                                     FROM fit f CROSS JOIN points WHERE f.moving AND f.step < 300)
                               GROUP BY k, i) n ON n.k = o.k AND n.i = o.i)
                GROUP BY k))"""
    )
    parts.append("fitted AS MATERIALIZED (SELECT k, arg_max(cs, step) AS cs FROM fit GROUP BY k)")
    zs = f"[{', '.join(f'z_{c}' for c in COLUMNS)}]"
    gaps = f"list_transform(cs, lambda c: {_distance(zs, 'c')})"
    return ",\n".join(parts) + "," + _silhouette(f"SELECT k, list_position({gaps}, list_min({gaps})) AS cl, z.* FROM fitted CROSS JOIN z")


_BEST_K = "(SELECT min(k) FROM scores WHERE silhouette = (SELECT max(silhouette) FROM scores))"


def _fitted_query(body: str) -> str:
    return _query("SELECT 1", "z").replace("WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT 1", f",\n{_fits(8)}\n{body}")


SPREAD = {k: [[-1.0 + 2.0 * i / (k - 1)] * len(COLUMNS) for i in range(k)] for k in range(3, 9)}

_NEEDS: dict[str, list[str]] = {
    "f_customers": ["r_customers"],
    "f_products": ["r_products"],
    "f_orders": ["r_orders"],
    "f_items": ["r_items"],
    "f_items_twice": ["r_items"],
    "f_dates": ["dates"],
    "dates": ["r_orders"],
    "reload": ["r_orders"],
    "kept": ["r_orders"],
    "done": ["r_orders"],
    "clean": ["r_items", "kept"],
    "behaviour": ["r_items", "kept"],
    "spent": ["clean", "r_products"],
    "favourite": ["spent"],
    "measures": ["behaviour"],
    "metrics": ["r_customers", "measures", "favourite"],
    "rfm": ["done"],
    "rfm_earlier": ["done"],
    "ranked": ["rfm"],
    "scores": ["ranked"],
    "segmented": ["scores"],
    "visits": ["done"],
    "retention": ["visits"],
    "features": ["metrics"],
    "z": ["features"],
    "distances": ["z"],
    "clusters": ["distances"],
}


def _query(body: str, *needs: str) -> str:
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in wanted:
            wanted.append(name)

    for name in needs:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in wanted) + f"\n{body}"


def _check(name: str, bad_rows: str) -> str:
    return f"SELECT '{name}' AS \"check\", ({bad_rows}) = 0 AS passed, ({bad_rows})::bigint AS bad_rows"


def _checks(rows: dict[str, str]) -> str:
    return "\nUNION ALL ".join(_check(name, f"SELECT {body}") for name, body in rows.items())


_TABLES = {
    "dim_customers": "f_customers",
    "dim_products": "f_products",
    "dim_date": "f_dates",
    "fact_orders": "f_orders",
    "fact_order_items": "f_items_twice",
}


def _shared_keys(table: str, key: str) -> str:
    return (
        f"count(*) FROM {table} WHERE {key} IS NULL OR {key} IN "
        f"(SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"
    )


def _parentless(child: str, column: str, parent: str, key: str) -> str:
    return f"count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"


def _outside(table: str, column: str, values: list[str]) -> str:
    return f"count(*) FROM {table} WHERE {column} NOT IN ({', '.join(repr(v) for v in values)})"


_UNIQUE = {
    f"unique_key:{name}": _shared_keys(_TABLES[name], key)
    for name, key in {
        "dim_customers": "customer_id",
        "dim_products": "product_id",
        "dim_date": "date_key",
        "fact_orders": "order_id",
        "fact_order_items": "order_item_id",
    }.items()
}
_FOREIGN = {
    "foreign_key:fact_orders.customer_id": _parentless("f_orders", "customer_id", "f_customers", "customer_id"),
    "foreign_key:fact_orders.order_date": _parentless("f_orders", "order_date", "f_dates", "date_key"),
    "foreign_key:fact_order_items.order_id": _parentless("f_items", "order_id", "f_orders", "order_id"),
    "foreign_key:fact_order_items.product_id": _parentless("f_items", "product_id", "f_products", "product_id"),
}
_ACCEPTED = {
    "dim_customers": {
        "country": ["US", "CA", "GB", "IN", "AU"],
        "channel": ["web", "mobile", "marketplace"],
        "email_domain": ["gmail.com", "outlook.com", "yahoo.com", "proton.me"],
    },
    "dim_products": {
        "category": ["Electronics", "Apparel", "Home", "Beauty", "Sports", "Grocery"],
        "brand": ["Nova", "Apex", "Zenith", "Orbit", "Pulse", "Vertex"],
    },
    "fact_orders": {
        "status": ["completed", "cancelled", "returned"],
        "payment_type": ["card", "paypal", "apple_pay", "google_pay"],
    },
}
_VALUES = {
    f"accepted_values:{table}.{column}": _outside(_TABLES[table], column, values)
    for table, columns in _ACCEPTED.items()
    for column, values in columns.items()
}
_LINES = "f_items i JOIN f_orders o ON i.order_id = o.order_id"
_RECONCILE = {
    "line_total_is_price_times_quantity": (
        f"count(*) FROM {_LINES} WHERE status <> 'cancelled' AND line_total <> unit_price * quantity"
    ),
    "order_total_is_lines_less_discount_plus_shipping": (
        "count(*) FROM f_orders o LEFT JOIN (SELECT order_id, sum(line_total) AS lines FROM f_items GROUP BY order_id) l "
        "ON o.order_id = l.order_id WHERE status <> 'cancelled' "
        "AND order_total <> coalesce(lines, 0) - discount_total + shipping_total"
    ),
    "cancelled_orders_are_zero": (
        "count(*) FROM f_orders WHERE status = 'cancelled' "
        "AND (order_total <> 0 OR discount_total <> 0 OR shipping_total <> 0)"
    ),
    "cancelled_lines_are_zero": f"count(*) FROM {_LINES} WHERE status = 'cancelled' AND line_total <> 0",
}
_STANDING = {
    "no_negative_revenue_completed": "count(*) FROM f_orders WHERE status = 'completed' AND order_total < 0",
    "positive_quantity_items": "count(*) FROM f_items WHERE quantity <= 0",
    "no_orphan_order_items": "count(*) FROM f_items WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM f_orders WHERE order_id IS NOT NULL)",
}

_ITEM_COLUMNS = "order_item_id, order_id, product_id, quantity, unit_price, line_total"

ORACLES: dict[str, str] = {
    "csv_customers": _query("SELECT * FROM r_customers", "r_customers"),
    "csv_products": _query("SELECT * FROM r_products", "r_products"),
    "csv_order_items": _query("SELECT * FROM r_items", "r_items"),
    "csv_orders": _query("SELECT * FROM r_orders", "r_orders"),
    "stored_orders": _query(
        f"""SELECT * FROM r_orders
            WHERE order_date < DATE '{LOADED_UNTIL}' AND order_id NOT IN (SELECT order_id FROM reload)
            UNION ALL SELECT * FROM reload""",
        "reload",
    ),
    "rfm_base_upsert": _query(
        """SELECT * FROM rfm UNION ALL
           SELECT * FROM rfm_earlier WHERE customer_id NOT IN (SELECT customer_id FROM rfm)""",
        "rfm",
        "rfm_earlier",
    ),
    "dim_customers": _query("SELECT DISTINCT * FROM r_customers", "r_customers"),
    "dim_products": _query("SELECT DISTINCT * FROM r_products", "r_products"),
    "dim_date": _query("SELECT * FROM dates", "dates"),
    "fact_orders": _query("SELECT * FROM r_orders", "r_orders"),
    "fact_order_items": _query("SELECT * FROM r_items", "r_items"),
    "upsert_orders": _query(
        f"""SELECT * FROM r_orders
            WHERE order_date < DATE '{LOADED_UNTIL}' AND order_id NOT IN (SELECT order_id FROM reload)
            UNION ALL SELECT * FROM reload""",
        "reload",
    ),
    "insert_new_dates": _query(
        f"SELECT * REPLACE (CASE WHEN date_key < DATE '{LOADED_UNTIL}' THEN 0 ELSE week END AS week) FROM dates", "dates"
    ),
    "orders_completed": _query("SELECT * FROM done", "done"),
    "orders_non_cancelled": _query("SELECT * FROM kept", "kept"),
    "published_views": _query(
        """SELECT 'v_orders_completed' AS view, count(*) AS n_rows, sum(order_total)::decimal(22,2) AS amount FROM done
           UNION ALL SELECT 'v_orders_non_cancelled', count(*), sum(order_total)::decimal(22,2) FROM kept
           UNION ALL SELECT 'v_order_items_clean', count(*), sum(line_total)::decimal(22,2)
           FROM f_items JOIN kept USING (order_id) WHERE quantity > 0 AND unit_price >= 0""",
        "done",
        "kept",
        "f_items",
    ),
    "items_clean": _query(f"SELECT {_ITEM_COLUMNS} FROM clean", "clean"),
    "basket_size": _query("SELECT customer_id, mean_basket AS avg_basket_size FROM measures WHERE n_baskets > 0", "measures"),
    "category_revenue": _query("SELECT * FROM spent", "spent"),
    "dominant_category": _query("SELECT * FROM favourite", "favourite"),
    "returns_rate": _query("SELECT customer_id, share_returned AS returns_rate FROM measures", "measures"),
    "purchase_frequency": _query("SELECT customer_id, monthly AS purchase_frequency_per_mo FROM measures", "measures"),
    "purchase_frequency_strict": _query("SELECT customer_id, monthly_strict AS purchase_frequency_per_mo FROM measures", "measures"),
    "customer_base": _query(
        """SELECT customer_id, first_day AS first_purchase_date, last_day AS last_purchase_date, coalesce(n_orders, 0)::int AS total_orders,
                  coalesce(paid, 0)::decimal(14,2) AS total_revenue, mean_paid AS avg_order_value
           FROM (SELECT customer_id FROM r_customers) LEFT JOIN measures USING (customer_id)""",
        "r_customers",
        "measures",
    ),
    "customer_360": _query("SELECT * FROM metrics", "metrics"),
    "stored_marts": _query("SELECT * FROM metrics", "metrics"),
    "daily_job": _query("SELECT * FROM metrics", "metrics"),
    "customer_360_today": _query(
        "SELECT * REPLACE ((current_date - last_purchase_date)::int AS days_since_last_purchase) FROM metrics", "metrics"
    ),
    "appended_orders": _query("SELECT * FROM r_orders", "r_orders"),
    "missing_files": _query(
        """SELECT 'raw_customers' AS "table", count(*)::bigint AS n_rows FROM r_customers
           UNION ALL SELECT 'raw_products', count(*)::bigint FROM r_products
           UNION ALL SELECT 'raw_orders', NULL UNION ALL SELECT 'raw_order_items', NULL""",
        "r_customers",
        "r_products",
    ),
    "empty_marts": _query(
        f"""SELECT day, (SELECT count(*) FROM done WHERE order_date >= day::date - 365) = 0 AS stopped
            FROM (VALUES ('{AS_OF}'), ('2003-01-01')) days(day)""",
        "done",
    ),
    "preview_orders": _query("SELECT * FROM r_orders ORDER BY order_id LIMIT 2", "r_orders"),
    "recreated_clusters": _query("SELECT * FROM clusters", "clusters"),
    "rfm_base": _query("SELECT * FROM rfm", "rfm"),
    "rfm_ranks": _query(
        "SELECT customer_id, monetary_value, mr AS rank, m_score AS quintile FROM ranked JOIN scores USING (customer_id, monetary_value)",
        "scores",
    ),
    "rfm_segments": _query("SELECT * FROM segmented", "segmented"),
    "rfm_scored": _query("SELECT customer_id, r_score, f_score, m_score, rfm_score, segment FROM segmented", "segmented"),
    "rfm_segment_counts": _query("SELECT segment, count(*) AS customers FROM segmented GROUP BY segment", "segmented"),
    "cohort_first_purchase": _query("SELECT DISTINCT customer_id, joined AS cohort_month FROM visits", "visits"),
    "cohort_retention": _query("SELECT * FROM retention ORDER BY cohort_month, active_month", "retention"),
    "retention_curve": _query(
        """SELECT ((year(active_month) - year(cohort_month)) * 12 + month(active_month) - month(cohort_month))::int
                  AS month_index, sum(retention_rate)::double / count(*) AS retention_rate
           FROM retention GROUP BY 1 ORDER BY 1""",
        "retention",
    ),
    "segment_report": _query(
        """SELECT segment, count(*) AS customers, sum(monetary_value)::decimal(24,2) AS revenue_365d
           FROM segmented GROUP BY segment ORDER BY revenue_365d DESC""",
        "segmented",
    ),
    "dq_report": _query(_checks(_STANDING), "f_orders", "f_items"),
    "dq_unique_keys": _query(_checks(_UNIQUE), *_TABLES.values()),
    "dq_foreign_keys": _query(_checks(_FOREIGN), *_TABLES.values(), "f_items"),
    "dq_accepted_values": _query(_checks(_VALUES), "f_customers", "f_products", "f_orders"),
    "dq_reconcile": _query(_checks(_RECONCILE), "f_orders", "f_items"),
    "cluster_features": _query("SELECT * FROM features", "features"),
    "standardized_features": _query(
        "SELECT customer_id, " + ", ".join(f"round(z_{c}, 6) AS {c}" for c in COLUMNS) + " FROM z", "z"
    ),
    "silhouette_fixed": _query("SELECT k::int AS k, round(silhouette, 5) AS silhouette FROM scores", "z").replace(
        "\nSELECT k::int", f",{_silhouette(_labels({4: CENTERS}))}\nSELECT k::int"
    ),
    "choose_k_fixed": _query(
        """SELECT k::int AS k, round(silhouette, 5) AS silhouette,
                  k = (SELECT min(k) FROM scores WHERE silhouette = (SELECT max(silhouette) FROM scores)) AS chosen
           FROM scores""",
        "z",
    ).replace("\nSELECT k::int", f",{_silhouette(_labels(SPREAD))}\nSELECT k::int"),
    "kmeans_choose_k": _fitted_query(f"SELECT k::int AS k, round(silhouette, 5) AS silhouette, k = {_BEST_K} AS chosen FROM scores"),
    "customer_clusters": _fitted_query(f"SELECT customer_id, (cl - 1)::int AS cluster_id, {', '.join(COLUMNS)} FROM l WHERE k = {_BEST_K}"),
    "lloyd_fixed": _query(
        "SELECT c.cl::int AS cluster_id, "
        + ", ".join(f"round(any_value(c.z_{c}), 4) AS {c}" for c in COLUMNS)
        + ", count(n.cl) AS customers FROM c3 c LEFT JOIN n3 n ON n.cl = c.cl GROUP BY c.cl",
        "z",
    ).replace("\nSELECT c.cl::int", f",\n{_lloyd(3)}\nSELECT c.cl::int"),
    "cluster_assign_fixed": _query("SELECT * FROM clusters", "clusters"),
    "cluster_profile_fixed": _query(
        "SELECT cluster_id, "
        + ", ".join(f"round_even(sum({c})::double / count({c}), 2) AS {c}" for c in COLUMNS)
        + " FROM clusters GROUP BY cluster_id",
        "clusters",
    ),
    "cluster_report_fixed": _query(
        """SELECT cluster_id, sum(total_revenue)::double / count(*) AS avg_revenue,
                  sum(total_orders)::double / count(*) AS avg_orders
           FROM clusters GROUP BY cluster_id ORDER BY cluster_id""",
        "clusters",
    ),
}
