"""Oracle SQL (DuckDB dialect) for every registered query.

Named CTEs depend on each other; ``sql(body, *names)`` emits the needed
ones in dependency order, starting from the stand-in inputs of
``martline.sources.fixtures``. The text is written independently of the
Spark code (window functions and joins, not the DataFrame operators), so a
match is evidence and not an echo."""

from __future__ import annotations

from martline.sources.fixtures import SQL as RAW_SQL

TS = ("order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, "
      "order_delivered_customer_date, order_estimated_delivery_date")
TS_NL = ("order_purchase_timestamp NULLS LAST, order_approved_at NULLS LAST, "
         "order_delivered_carrier_date NULLS LAST, order_delivered_customer_date NULLS LAST, "
         "order_estimated_delivery_date NULLS LAST")


def initcap(expr: str) -> str:
    """Spark's initcap: lower-case, then upper-case the first letter of each
    space-separated word."""
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


CTE: dict[str, tuple[list[str], str]] = {}


def _def(name: str, deps: list[str], text: str) -> None:
    CTE[name] = (deps, text)


for _n, _t in RAW_SQL.items():
    _def(f"raw_{_n}", [], _t)

_def("clean_orders", ["raw_orders"], f"""
SELECT order_id, customer_id, order_status, {TS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {TS_NL},
                               customer_id NULLS LAST, order_status NULLS LAST) AS rn
  FROM raw_orders
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND order_status IS NOT NULL) x
WHERE rn = 1""")

_def("clean_items", ["raw_items"], """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id NULLS LAST,
           seller_id NULLS LAST, shipping_limit_date NULLS LAST, price NULLS LAST,
           freight_value NULLS LAST) AS rn
  FROM raw_items
  WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL
    AND seller_id IS NOT NULL AND price >= 0 AND freight_value >= 0) x
WHERE rn = 1""")

_def("clean_payments", ["raw_payments"], """
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, payment_sequential ORDER BY
           payment_type NULLS LAST, payment_installments NULLS LAST, payment_value NULLS LAST) AS rn
  FROM raw_payments
  WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL AND payment_type IS NOT NULL
    AND payment_installments >= 0 AND payment_value >= 0) x
WHERE rn = 1""")

# The consumer's rules are a subset of the producer's, so staged = clean.
_def("staged_orders", ["clean_orders"],
     "SELECT * FROM clean_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL")
_def("staged_items", ["clean_items"], "SELECT * FROM clean_items")
_def("staged_payments", ["clean_payments"], "SELECT * FROM clean_payments")

_def("payments_agg", ["staged_payments"], """
SELECT order_id, sum(payment_value) AS total_payment_value, count(*) AS payment_count,
       max(payment_installments) AS max_installments
FROM staged_payments GROUP BY order_id""")

_def("dim_customer", ["raw_customers"], f"""
SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key, customer_id,
       customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS LAST,
           customer_zip_code_prefix NULLS LAST, customer_city NULLS LAST, customer_state NULLS LAST) AS rn
  FROM (SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
               CAST(customer_zip_code_prefix AS INT) AS customer_zip_code_prefix,
               {initcap('trim(customer_city)')} AS customer_city,
               upper(trim(customer_state)) AS customer_state
        FROM raw_customers) c
  WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL) d
WHERE rn = 1""")

_def("translation", ["raw_translation"], """
SELECT pt, en FROM (
  SELECT pt, en, row_number() OVER (PARTITION BY pt ORDER BY en NULLS LAST) AS rn
  FROM (SELECT trim(product_category_name) AS pt, trim(product_category_name_english) AS en
        FROM raw_translation) t0
  WHERE pt IS NOT NULL) t1
WHERE rn = 1""")

_def("dim_product", ["raw_products", "translation"], """
SELECT CAST(row_number() OVER (ORDER BY product_id) AS BIGINT) AS product_key, product_id,
       product_category_name_pt, product_category_name, product_name_length,
       product_description_length, product_photos_qty, product_weight_g, product_length_cm,
       product_height_cm, product_width_cm FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_category_name_pt NULLS LAST,
           product_name_length NULLS LAST, product_description_length NULLS LAST,
           product_photos_qty NULLS LAST, product_weight_g NULLS LAST, product_length_cm NULLS LAST,
           product_height_cm NULLS LAST, product_width_cm NULLS LAST,
           product_category_name NULLS LAST) AS rn
  FROM (SELECT p.*, coalesce(t.en, p.product_category_name_pt) AS product_category_name
        FROM (SELECT trim(product_id) AS product_id,
                     trim(product_category_name) AS product_category_name_pt,
                     CAST(product_name_lenght AS INT) AS product_name_length,
                     CAST(product_description_lenght AS INT) AS product_description_length,
                     CAST(product_photos_qty AS INT) AS product_photos_qty,
                     CAST(product_weight_g AS INT) AS product_weight_g,
                     CAST(product_length_cm AS INT) AS product_length_cm,
                     CAST(product_height_cm AS INT) AS product_height_cm,
                     CAST(product_width_cm AS INT) AS product_width_cm
              FROM raw_products) p
        LEFT JOIN translation t ON p.product_category_name_pt = t.pt) j
  WHERE product_id IS NOT NULL) d
WHERE rn = 1""")

_def("dim_seller", ["raw_sellers"], f"""
SELECT CAST(row_number() OVER (ORDER BY seller_id) AS BIGINT) AS seller_key, seller_id,
       seller_zip_code_prefix, seller_city, seller_state FROM (
  SELECT *, row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS LAST,
           seller_city NULLS LAST, seller_state NULLS LAST) AS rn
  FROM (SELECT trim(seller_id) AS seller_id,
               CAST(seller_zip_code_prefix AS INT) AS seller_zip_code_prefix,
               {initcap('trim(seller_city)')} AS seller_city,
               upper(trim(seller_state)) AS seller_state
        FROM raw_sellers) s
  WHERE seller_id IS NOT NULL) d
WHERE rn = 1""")

FACT_COLS = (f"fact_sales_key, order_id, order_item_id, customer_key, product_key, seller_key, "
             f"customer_id, product_id, seller_id, order_status, {TS}, shipping_limit_date, "
             f"price, freight_value, gross_sales_value, delivery_days, estimated_delivery_days, "
             f"is_delayed")

_def("fact_sales", ["staged_orders", "staged_items", "dim_customer", "dim_product", "dim_seller"], f"""
SELECT {FACT_COLS} FROM (
  SELECT CAST(row_number() OVER (ORDER BY i.order_id, i.order_item_id) AS BIGINT) AS fact_sales_key,
         i.order_id, i.order_item_id, dc.customer_key, dp.product_key, ds.seller_key,
         o.customer_id, i.product_id, i.seller_id, o.order_status,
         o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         i.shipping_limit_date, i.price, i.freight_value,
         i.price + i.freight_value AS gross_sales_value,
         CAST(date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) AS INT) AS delivery_days,
         CAST(date_diff('day', o.order_purchase_timestamp, o.order_estimated_delivery_date) AS INT) AS estimated_delivery_days,
         CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END AS is_delayed
  FROM staged_items i
  JOIN staged_orders o ON i.order_id = o.order_id
  LEFT JOIN dim_customer dc ON o.customer_id = dc.customer_id
  LEFT JOIN dim_product dp ON i.product_id = dp.product_id
  LEFT JOIN dim_seller ds ON i.seller_id = ds.seller_id) f""")

_def("fact_sales_enriched", ["fact_sales", "payments_agg"], f"""
SELECT {', '.join('f.' + c.strip() for c in FACT_COLS.split(','))},
       coalesce(p.total_payment_value, 0.0) AS total_payment_value,
       coalesce(p.payment_count, 0) AS payment_count,
       coalesce(p.max_installments, 0) AS max_installments,
       CASE WHEN coalesce(p.payment_count, 0) > 0
            THEN coalesce(p.total_payment_value, 0.0) / p.payment_count ELSE 0.0 END AS avg_payment_value
FROM fact_sales f LEFT JOIN payments_agg p ON f.order_id = p.order_id""")


def sql(body: str, *names: str) -> str:
    """``WITH`` the named CTEs (and their dependencies, in order) + ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order)
    body = body.strip()
    if not order:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
