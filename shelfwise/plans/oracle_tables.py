"""The derived tables of ``adapters`` as SQL common table expressions."""

from __future__ import annotations

from shelfwise.plans import adapters as A


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def pick(values, index: str) -> str:
    return f"{_list(values)}[CAST({index} AS INTEGER) + 1]"


def alternatives(words) -> str:
    return "(?i)" + "|".join(words)


PRODUCTS = "(SELECT greatest(count(*), 1) FROM part)"
_USER = "e.user_id"
_CATS = (f"[{pick(A.PART_TYPES, 'u % 6')}, {pick(A.PART_TYPES, '(u + 2) % 6')}]")
_FEATS = (f"[{pick(A.FIRST_WORDS, 'u % 8')}, upper(substr({pick(A.LAST_WORDS, 'u % 7')}, 1, 3))]")

CTES: dict[str, str] = {
    "products": """SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_type AS category,
        p_retailprice AS price FROM part""",
    "product_records": """SELECT CASE WHEN p_partkey % 37 <> 0 THEN p_partkey END AS id,
        CASE WHEN p_partkey % 23 <> 0 THEN p_brand END AS brand,
        CASE WHEN p_partkey % 29 = 0 THEN '' ELSE p_name END AS name,
        'SKU-' || p_partkey AS sku,
        CASE WHEN p_partkey % 31 = 0 THEN '' ELSE p_type END AS model,
        CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) / CAST(8.0 AS DOUBLE) END
            AS average_rating,
        CASE WHEN p_partkey % 41 = 0 THEN 'n/a' ELSE '2024-01-05 10:00:00' END AS created_at,
        '2024-01-06 11:30:00' AS updated_at, p_partkey % 2 = 0 AS is_active,
        CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 4 = 0 END AS is_featured FROM part""",
    "anomaly_products": """SELECT p_partkey AS id,
        CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS category_id, p_brand AS brand,
        p_name AS name FROM part""",
    "users": f"""SELECT c_custkey AS id,
        CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'user' || c_custkey || '@shop.example' END
            AS email,
        c_name AS username, CASE WHEN c_custkey % 19 <> 0 THEN c_mktsegment END AS first_name,
        'No ' || c_custkey AS last_name,
        CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '*' END AS password, c_acctbal > 0 AS active,
        {pick(("admin", "user", "guest", "root"), "c_custkey % 4")} AS role,
        CASE WHEN c_custkey % 13 = 0 THEN 'yesterday' ELSE '2023-05-01' END AS create_time,
        '2023-06-01 08:00:00' AS update_time FROM customer""",
    "legacy_users": """SELECT CASE WHEN c_custkey % 17 <> 0 THEN c_custkey // 3 END AS user_id,
        CASE WHEN c_custkey % 7 = 0 THEN 'no address'
             ELSE 'u' || c_custkey || '@shop.example' END AS email,
        '  ' || c_name || ' ' AS name, 1000 - c_custkey // 2 AS updated FROM customer""",
    "sales": """SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at
        FROM orders""",
    "order_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
        CAST(trunc(l_quantity) AS INTEGER) % 3 + 1 AS quantity FROM lineitem""",
    "returns": f"""SELECT l_orderkey AS id, l_partkey AS product_id, o_custkey AS user_id,
        l_shipdate AS created_at,
        CASE WHEN l_orderkey % 29 = 0 THEN lower(code) WHEN l_orderkey % 43 <> 0 THEN code END
            AS reason
        FROM (SELECT *, {pick(A.RETURN_CODES, "(l_partkey + l_linenumber) % 17")} AS code
              FROM lineitem WHERE l_returnflag = 'R') JOIN orders ON o_orderkey = l_orderkey""",
    "payments": f"""SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 31 <> 0 THEN o_custkey END AS user_id,
        CASE WHEN o_orderkey % 37 = 0 THEN -o_totalprice
             WHEN o_orderkey % 41 <> 0 THEN o_totalprice END AS amount,
        CASE WHEN o_orderkey % 23 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 29 <> 0
             THEN {pick(("SUCCESS", "PENDING", "FAILED"), "o_orderkey % 3")} END
            AS payment_status, o_orderdate AS created_at FROM orders""",
    "enriched_events": f"""SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
        event_id * 7 % {PRODUCTS} + CASE WHEN event_id % 19 = 0 THEN {A.ORPHAN} ELSE 0 END AS wanted
        FROM events""",
    "cart_item": """SELECT CASE WHEN event_id % 29 = 0 THEN event_id - 1 ELSE event_id END AS id,
        CASE WHEN event_id % 31 <> 0 THEN user_id END AS cart_id, wanted AS product_id,
        k - 10 AS quantity, CASE WHEN event_id % 17 <> 0 THEN value - 5 END AS price,
        ts AS updated_at, ' ' || upper(event_type) || ' ' AS status, ts AS last_updated
        FROM d_enriched_events""",
    "wishlist": """SELECT event_id AS id, user_id, wanted AS product_id,
        CASE WHEN event_id % 13 = 0 THEN upper(p.name) ELSE p.name END AS name,
        CASE WHEN event_id % 11 = 0 THEN p.brand || '-x' ELSE p.brand END AS brand,
        value AS price, value * CAST(0.5 AS DOUBLE) - 5 AS discounted_price,
        CASE WHEN event_id % 23 <> 0 THEN CAST(k AS DOUBLE) / CAST(10.0 AS DOUBLE) END AS rating,
        k - 2 AS review_count, ts AS create_time
        FROM d_enriched_events LEFT JOIN d_products p ON p.id = wanted""",
    "images": """SELECT p_partkey AS product_id, CAST(n AS INTEGER) AS image_no,
        'img/' || p_partkey || '/' || n AS url
        FROM part, unnest(range(1, p_partkey % 3 + 1)) AS t(n)""",
    "specs": """SELECT p_partkey AS product_id, CAST(n AS INTEGER) AS spec_no,
        'spec ' || n AS text FROM part, unnest(range(1, (p_partkey + 1) % 3 + 1)) AS t(n)""",
    "inventories": """SELECT l_partkey AS product_id, count(*) AS movements,
        max(l_shipdate) AS last_movement FROM lineitem GROUP BY 1""",
    "engine_events": f"""SELECT event_id, ts, user_id, CASE event_type WHEN 'view' THEN
        'product_view' WHEN 'purchase' THEN 'product_purchase' ELSE event_type END AS event_type,
        event_id * 7 % {PRODUCTS} AS product_id FROM events""",
    "profiles": f"""SELECT u AS user_id, {_CATS} AS cats, {_FEATS} AS feats
        FROM (SELECT DISTINCT user_id AS u FROM events) WHERE u % 10 <> 9""",
    "views": """SELECT e.event_id, e.ts, e.user_id, e.product_id, p.name AS product_name,
        p.category, e.user_id % 10 <> 9 AS has_user_profile
        FROM d_engine_events e JOIN d_products p ON p.id = e.product_id
        WHERE e.event_type = 'product_view'""",
    # Brute force: the tier of every product for every distinct (preferences, viewed product).
    "situations": """SELECT DISTINCT v.product_id, v.category, v.has_user_profile,
        CASE WHEN has_user_profile THEN f.cats END AS cats,
        CASE WHEN has_user_profile THEN f.feats END AS feats
        FROM d_views v LEFT JOIN d_profiles f USING (user_id)""",
    "ranked": """SELECT s.*, p.id, p.name, p.category AS rec_category, p.price,
        CASE WHEN list_contains(s.cats, p.category) THEN 1
             WHEN contains(p.name, lower(s.feats[1])) OR contains(p.name, lower(s.feats[2])) THEN 2
             WHEN p.category = s.category THEN 3 ELSE 4 END AS tier
        FROM d_situations s JOIN d_products p ON p.id <> s.product_id""",
    "recommended": """SELECT * EXCLUDE (r) , CAST(r AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id, cats, feats ORDER BY tier,
            CASE WHEN tier < 4 THEN id ELSE (id * 7919 + 17) % 1000003 END, id) AS r
        FROM d_ranked) WHERE r <= 5""",
    "view_recs": """SELECT v.event_id, v.ts, v.user_id, v.product_name AS viewed_product_name,
        v.has_user_profile, r.* EXCLUDE (has_user_profile)
        FROM d_views v LEFT JOIN d_profiles f ON f.user_id = v.user_id
        JOIN d_recommended r ON r.product_id = v.product_id
         AND r.cats IS NOT DISTINCT FROM f.cats AND r.feats IS NOT DISTINCT FROM f.feats""",
    "relevant": """SELECT f.user_id, count(*) FILTER (list_contains(f.cats, p.category)
            OR contains(p.name, lower(f.feats[1])) OR contains(p.name, lower(f.feats[2])))
        AS relevant_products FROM d_profiles f CROSS JOIN d_products p GROUP BY 1""",
    "counters": """SELECT event_id, any_value(ts) AS ts, any_value(user_id) AS user_id,
        count(*) AS n_recs, count(*) FILTER (tier <= 2) AS n_relevant,
        any_value(relevant_products) AS relevant_products
        FROM d_view_recs JOIN d_relevant USING (user_id) WHERE has_user_profile GROUP BY 1""",
    "user_counters": """SELECT user_id, CAST(sum(n_recs) AS BIGINT) AS total_recommendations,
        CAST(sum(n_relevant) AS BIGINT) AS relevant_recommendations,
        CAST(coalesce(arg_min(relevant_products, struct_pack(t := ts, e := event_id))
             FILTER (relevant_products > 0), 0) AS BIGINT) AS total_relevant_products,
        CAST(sum(n_relevant) AS BIGINT) AS relevant_products_recommended
        FROM d_counters GROUP BY 1""",
}

NEEDS = {
    "cart_item": ["enriched_events"],
    "wishlist": ["enriched_events", "products"],
    "views": ["engine_events", "products"],
    "situations": ["views", "profiles"],
    "ranked": ["situations"],
    "recommended": ["ranked"],
    "view_recs": ["recommended"],
    "relevant": ["profiles", "products"],
    "counters": ["view_recs", "relevant"],
    "user_counters": ["counters"],
}

SCORES = """CASE WHEN total_recommendations > 0 THEN
        CAST(relevant_recommendations AS DOUBLE) / total_recommendations ELSE 0.0 END AS precision,
    CASE WHEN total_relevant_products > 0 THEN
        CAST(relevant_products_recommended AS DOUBLE) / total_relevant_products ELSE 0.0 END
        AS recall"""
F1 = """CASE WHEN precision + recall > 0 THEN
        CAST(2.0 AS DOUBLE) * (precision * recall) / (precision + recall) ELSE 0.0 END AS f1"""


def scored(body: str) -> str:
    """A query giving the four counters, extended by precision, recall and F1."""
    return f"SELECT *, {F1} FROM (SELECT *, {SCORES} FROM ({body}))"


def with_tables(names: str, body: str, **more: str) -> str:
    """``body`` after the named tables and all they need; each is called ``d_`` + its name."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    parts = [f"d_{n} AS ({CTES[n]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in more.items()]
    return f"WITH {', '.join(parts)} {body}"
