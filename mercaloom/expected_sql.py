"""The expected results as DuckDB SQL over the test tables, written apart from the Spark jobs."""

from __future__ import annotations

from typing import NamedTuple

# Per table its columns with type, kind for the profile, whether needed, and the longest text or the
# bound of the number.
RAW = {
    "orders": """
        order_id string text needed 50
        customer_id string text needed 50
        order_status string text needed 20
        order_purchase_timestamp string date 50
        order_approved_at string text 50
        order_delivered_carrier_date string date 50
        order_delivered_customer_date string date 50
        order_estimated_delivery_date string date 50
    """,
    "order_items": """
        order_id string text needed 50
        order_item_id int number needed
        product_id string text needed 50
        seller_id string text needed 50
        shipping_limit_date string date needed 50
        price decimal(10,2) number needed
        freight_value decimal(10,2) number needed
    """,
    "customers": """
        customer_id string text needed 50
        customer_unique_id string text needed 50
        customer_zip_code_prefix string text 10
        customer_city string text 100
        customer_state string text 2
    """,
    "products": """
        product_id string text needed 50
        product_category_name string text 100
        product_name_length int number
        product_description_length int number
        product_photos_qty int number
        product_weight_g int number
        product_length_cm int number
        product_height_cm int number
        product_width_cm int number
    """,
    "sellers": """
        seller_id string text needed 50
        seller_zip_code_prefix string text 10
        seller_city string text 100
        seller_state string text 2
    """,
    "payments": """
        order_id string text needed 50
        payment_sequential int number needed
        payment_type string text 50
        payment_installments int number
        payment_value decimal(10,2) number
    """,
    "reviews": """
        review_id string text needed 50
        order_id string text needed 50
        review_score int number
        review_comment_title string text
        review_comment_message string text
        review_creation_date string date 50
        review_answer_timestamp string date 50
    """,
    "category_translation": """
        product_category_name string text needed 100
        product_category_name_english string text 100
    """,
    "geolocation": """
        geolocation_zip_code_prefix string text needed 10
        geolocation_lat decimal(10,7) number
        geolocation_lng decimal(10,7) number
        geolocation_city string text 100
        geolocation_state string text 2
    """,
}

STAR = {
    "dim_date": """
        date_key int number needed
        full_date date moment
    """,
    "dim_customer": """
        customer_sk bigint number needed
        customer_id string text 50
        customer_unique_id string text 50
        customer_zip_code_prefix string text 10
        customer_city string text 100
        customer_state string text 2
    """,
    "dim_seller": """
        seller_sk bigint number needed
        seller_id string text 50
        seller_zip_code_prefix string text 10
        seller_city string text 100
        seller_state string text 2
    """,
    "dim_product": """
        product_sk bigint number needed
        product_id string text 50
        category_pt string text 100
        category_en string text 100
        product_name_length int number
        product_description_length int number
        product_photos_qty int number
        product_weight_g int number
        product_length_cm int number
        product_height_cm int number
        product_width_cm int number
    """,
    "fact_sales": """
        sales_sk bigint number
        order_id string text needed 32
        order_item_id int number needed
        customer_sk bigint number needed
        seller_sk bigint number needed
        product_sk bigint number needed
        purchase_date_key int number needed
        delivered_date_key int number
        estimated_date_key int number needed
        price decimal(12,2) number needed
        freight_value decimal(12,2) number needed
        line_total decimal(13,2) number
        payment_type string text 20
        payment_installments int number
        payment_value decimal(20,2) number below 1e10
        review_score tinyint number
        order_status string text 20
        is_delivered int number
        is_canceled int number
        is_late int number
        days_to_deliver int number
        days_late int number
    """,
}

KEYS = {
    "dim_date": "date_key",
    "dim_customer": "customer_sk",
    "dim_seller": "seller_sk",
    "dim_product": "product_sk",
    "fact_sales": "sales_sk",
}


class Column(NamedTuple):
    name: str
    type: str
    kind: str
    needed: bool
    longest: int | None
    digits: int | None


def _columns(lines: str) -> list[Column]:
    out = []
    for line in lines.strip().splitlines():
        name, type_, kind, *rest = line.split()
        needed = "needed" in rest
        digits = int(rest[-1].removeprefix("1e")) if "below" in rest else None
        longest = int(rest[-1]) if rest and rest[-1].isdigit() else None
        out.append(Column(name, type_, kind, needed, longest, digits))
    return out


RAW_COLUMNS = {name: _columns(lines) for name, lines in RAW.items()}
# Not part of the star schema.
OTHER_COLUMNS = {
    "order_calendar": _columns("""
        date_key int number
        full_date date moment
        first_purchase timestamp moment
        any_canceled boolean truth
    """),
}
ALL_COLUMNS = RAW_COLUMNS | {name: _columns(lines) for name, lines in STAR.items()}


def _moment(text: str) -> str:
    """The moment a text names: a day with hyphens and perhaps a time, or eight digits, between spaces."""
    t = f"trim({text})"
    day, time = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{2}:[0-9]{2}"
    return (
        f"case when regexp_full_match({t}, '[0-9]{{8}}') then try_strptime({t}, '%Y%m%d')"
        f" when regexp_full_match({t}, '{day}') then try_strptime({t}, '%Y-%m-%d')"
        f" when regexp_full_match({t}, '{day}[ T]{time}') then try_strptime(replace({t}, 'T', ' '), '%Y-%m-%d %H:%M')"
        f" when regexp_full_match({t}, '{day}[ T]{time}:[0-9]{{2}}([.][0-9]{{1,9}})?')"
        f" then try_cast(left(replace({t}, 'T', ' '), 26) as timestamp) end"
    )


# The nine raw tables, derived from the test tables.
STAGING_CTES = """
base AS (
 select o_orderkey k, o_custkey u, o_totalprice tp,
  case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else case o_orderkey%3 when 0 then 'canceled' when 1 then 'unavailable' else 'delivered' end end st,
  o_orderdate + (o_orderkey%24)*interval '1' hour + (o_orderkey%60)*interval '1' minute pts, o_orderdate d from orders),
stg_orders AS (
 select case when k%101=0 then 'x' else 'o' end||cast(k as string) order_id, 'c'||cast(case when k%101=0 then k+1 else k end as string) customer_id, st order_status,
  cast(pts as string) order_purchase_timestamp,
  case when k%29<>0 then cast(pts+interval '1' hour as string) end order_approved_at,
  case when st in ('delivered','shipped') then cast(pts+interval '2' day as string) end order_delivered_carrier_date,
  case when k%211=0 then 'not a date' when k%211=1 then '2017-1-2 10:56:33.1' when k%211=2 then '2017/10/02'
   when (st='delivered' and k%37<>0) or (st='canceled' and k%5=0) then case k%13 when 1 then dl||'.125' when 2 then left(dl,16)
    when 3 then replace(dl,' ','T') when 4 then replace(left(dl,10),'-','') when 5 then dl||'  ' when 6 then ' '||left(dl,10) else dl end end order_delivered_customer_date,
  cast(d+(18+k%11)*interval '1' day as string) order_estimated_delivery_date
  from (select *, cast(d+(3+k%25)*interval '1' day+(k%24)*interval '1' hour as string) dl from base)),
stg_customers AS (
 select 'c'||cast(o_orderkey as string) customer_id,'u'||cast(c_custkey as string) customer_unique_id, case when c_custkey%83<>0 then cast(1000+c_custkey*53%90000 as string) end customer_zip_code_prefix,'  '||lower(n_name)||' ' customer_city, substr(r_name,1,2) customer_state
  from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey),
stg_sellers AS (
 select 's'||cast(s_suppkey as string) seller_id, cast(1000+s_suppkey as string) seller_zip_code_prefix,' '||lower(n_name) seller_city, substr(r_name,1,2) seller_state from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey),
stg_products AS (
 select 'p'||cast(p_partkey as string) product_id, case when p_partkey%61<>0 then lower(p_type) end product_category_name, cast(length(p_name) as int) product_name_length, p_size*10 product_description_length, case when p_partkey%53<>0 then cast(p_partkey%9 as int) end product_photos_qty, p_size*100 product_weight_g, p_size product_length_cm, p_size product_height_cm, p_size product_width_cm from part),
stg_category_translation AS (
 select distinct case when p_type='ECONOMY' then 'unused' else lower(p_type) end product_category_name,'en_'||lower(p_type) product_category_name_english from part),
stg_order_items AS (
 select 'o'||cast(l_orderkey as string) order_id, cast(row_number() over(partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity,l_shipdate) as int) order_item_id,'p'||cast(case when l_partkey%97=0 then l_partkey+1 else l_partkey end as string) product_id,'s'||cast(case when l_suppkey%17=0 then l_suppkey+1 else l_suppkey end as string) seller_id, cast(l_shipdate as string) shipping_limit_date, cast(l_extendedprice as decimal(10,2)) price, cast(l_quantity as decimal(10,2)) freight_value from lineitem),
stg_payments AS (
 select 'o'||cast(case when k%50=0 then k+1 else k end as string) order_id, cast(case when k%50=0 then seq+10 else seq end as int) payment_sequential, case when (k+seq)%11=0 then null else case (k+seq)%4 when 0 then 'credit_card' when 1 then 'boleto' when 2 then 'voucher' else 'debit_card' end end payment_type, cast(1+(k*seq)%10 as int) payment_installments, case when seq=1 then cast(tp as decimal(10,2)) else cast(seq as decimal(10,2)) end payment_value
  from base cross join (select * from (values (1),(2),(3)) v(seq)) v where seq<=1+k%3),
stg_reviews AS (
 select 'r'||cast(k as string)||'-'||cast(n as string) review_id,'o'||cast(case when k%8=0 then k+1 else k end as string) order_id, cast(1+(k+n*3)%5 as int) review_score, cast(null as string) review_comment_title, case when k%3=0 then 'text '||cast(k as string) end review_comment_message, cast(d+interval '30' day as string) review_creation_date, cast(pts+interval '31' day as string) review_answer_timestamp
  from base cross join (select * from (values (0),(1)) v(n)) v where n=0 or k%40=1),
stg_geolocation AS (
 select cast(1000+c_custkey*53%90000 as string) geolocation_zip_code_prefix, cast(cast(-23000 - c_custkey%1000 as decimal(12,3))*cast(0.001 as decimal(4,3)) as decimal(10,7)) geolocation_lat, cast(-46 as decimal(10,7)) geolocation_lng, lower(n_name) geolocation_city, substr(r_name,1,2) geolocation_state from customer join nation on c_nationkey=n_nationkey join region on n_regionkey=r_regionkey)
"""

# The star schema, with window functions over whole tables.
STAR_CTES = """
dim_date AS (
 select cast(strftime(d, '%Y%m%d') as int) date_key, cast(d as date) full_date
 from generate_series(timestamp '1995-01-01', timestamp '2002-12-31', interval '1' day) s(d)),
dim_customer AS (
 select row_number() over (order by customer_unique_id, customer_id) customer_sk, customer_id, customer_unique_id,
  customer_zip_code_prefix, upper(trim(customer_city)) customer_city, customer_state from stg_customers),
dim_seller AS (
 select row_number() over (order by seller_id) seller_sk, seller_id, seller_zip_code_prefix,
  upper(trim(seller_city)) seller_city, seller_state from stg_sellers),
dim_product AS (
 select row_number() over (order by product_id) product_sk, product_id,
  coalesce(p.product_category_name, 'Unknown') category_pt,
  coalesce(t.product_category_name_english, 'Unknown') category_en,
  product_name_length, product_description_length, product_photos_qty, product_weight_g,
  product_length_cm, product_height_cm, product_width_cm
 from stg_products p left join stg_category_translation t on p.product_category_name = t.product_category_name),
payment_per_order AS (
 select order_id, arg_min_null(payment_type, payment_sequential) payment_type,
  arg_min_null(payment_installments, payment_sequential) payment_installments,
  cast(sum(payment_value) as decimal(20,2)) payment_value from stg_payments group by order_id),
review_per_order AS (
 select order_id, round(avg(cast(review_score as double)), 1) avg_review_score from stg_reviews group by order_id),
moments AS (
 select order_id, PURCHASED bought, DELIVERED arrived, ESTIMATED promised from stg_orders),
order_calendar AS (
 select cast(strftime(d, '%Y%m%d') as int) date_key, cast(d as date) full_date, first_purchase, any_canceled
 from (select unnest(generate_series(min(bought)::date, max(bought)::date, interval '1' day)) d from moments)
 left join (select bought::date dd, min(bought) first_purchase, max(order_status in ('canceled', 'unavailable')) any_canceled
  from moments join stg_orders using (order_id) where bought is not null group by bought::date) on d::date = dd),
order_facts AS (
 select m.order_id, customer_sk, order_status, bought, arrived, promised,
  case when order_delivered_customer_date is null then 0 else 1 end is_delivered,
  case order_status when 'canceled' then 1 when 'unavailable' then 1 else 0 end is_canceled,
  coalesce((arrived > promised)::int, 0) is_late
 from stg_orders natural join moments m natural join dim_customer),
line_facts AS (
 select i.*, seller_sk, product_sk from stg_order_items i natural join (select seller_id, seller_sk from dim_seller)
  natural join (select product_id, product_sk from dim_product)),
fact_sales AS (
 select row_number() over (order by l.order_id, l.order_item_id) sales_sk, l.order_id, l.order_item_id,
  f.customer_sk, l.seller_sk, l.product_sk,
  (year(bought) * 10000 + month(bought) * 100 + day(bought))::int purchase_date_key,
  (year(arrived) * 10000 + month(arrived) * 100 + day(arrived))::int delivered_date_key,
  (year(promised) * 10000 + month(promised) * 100 + day(promised))::int estimated_date_key,
  l.price::decimal(12,2) price, l.freight_value::decimal(12,2) freight_value,
  (l.price + l.freight_value)::decimal(13,2) line_total,
  y.payment_type, y.payment_installments, y.payment_value,
  coalesce(trunc(r.avg_review_score), 0)::tinyint review_score, f.order_status,
  f.is_delivered, f.is_canceled, f.is_late,
  (arrived::date - bought::date)::int days_to_deliver, (arrived::date - promised::date)::int days_late
 from line_facts l natural join order_facts f
  left join payment_per_order y using (order_id) left join review_per_order r using (order_id))
"""
for _name, _column in (
    ("PURCHASED", "order_purchase_timestamp"),
    ("DELIVERED", "order_delivered_customer_date"),
    ("ESTIMATED", "order_estimated_delivery_date"),
):
    STAR_CTES = STAR_CTES.replace(_name, _moment(_column))

ORDER_GRAIN = """(select order_id, sum(days_to_deliver) ds, count(days_to_deliver) dn, max(days_to_deliver) d,
 sum(is_late) ll, sum(is_delivered) dl, max(is_late) l, max(is_delivered) dd, sum(line_total) v, count(*) n
 from fact_sales group by order_id)"""

DESCRIBED = ("orders", "order_items", "customers", "products")


def _profile(name: str, source: str | None = None) -> str:
    parts = []
    for c in (ALL_COLUMNS | OTHER_COLUMNS)[name]:
        kind, n = c.kind, c.name
        low, high, mean, length, negative, invalid = (
            "null::varchar",
            "null::varchar",
            "null::double",
            "null::double",
            "null::bigint",
            "null::bigint",
        )
        if kind in ("date", "number", "moment"):
            low, high = f"min({n})::varchar", f"max({n})::varchar"
        if kind in ("date", "text"):
            length = f"(sum(length(rtrim({n}))) // nullif(count({n}), 0))::double"
        if kind == "date":
            invalid = (
                f"sum(case when {n} is not null and {_moment(n)} is null"
                " then 1 else 0 end)::bigint"
            )
        if kind == "number":
            mean = f"round(avg({n}::double), 4)"
            negative = f"sum(case when {n} < 0 then 1 else 0 end)::bigint"
        parts.append(
            f"select '{name}' table_name, '{n}' column_name, count(*) total_rows,"
            f" count(distinct {n}) distinct_cnt,"
            f" sum(case when {n} is null then 1 else 0 end)::bigint null_cnt,"
            f" {low} min_val, {high} max_val, {mean} avg_val, {length} avg_length,"
            f" {negative} negative_cnt, {invalid} invalid_date from {source or _table(name)}"
        )
    return " union all ".join(parts)


def _orphans(child: str) -> str:
    return (
        f"select c.order_id, count(*) cnt from stg_{child} c left join stg_orders o"
        " on c.order_id = o.order_id where o.order_id is null group by c.order_id"
    )


def _unreferenced(parent: str, child: str, key: str, name: str) -> str:
    return (
        f"select count(*) {name} from stg_{parent} p left join stg_{child} c on p.{key} = c.{key}"
        f" where c.{key} is null"
    )


def _table(name: str) -> str:
    return f"stg_{name}" if name in RAW else name


def _primary_keys() -> str:
    parts = []
    for name, k in KEYS.items():
        parts.append(
            f"select '{name}' table_name, '{k}' key_column,"
            f" (select count(*) from (select {k} from {name} where {k} is not null"
            f" group by {k} having count(*) > 1)) duplicate_keys,"
            f" (select count(*) from {name} where {k} is null) null_rows"
        )
    return " union all ".join(parts)


def _foreign_keys(calendar: str) -> str:
    references = (
        ("customer_sk", "dim_customer", "dim_customer", "customer_sk"),
        ("seller_sk", "dim_seller", "dim_seller", "seller_sk"),
        ("product_sk", "dim_product", "dim_product", "product_sk"),
        ("purchase_date_key", "dim_date", calendar, "date_key"),
    )
    return " union all ".join(
        f"select 'fact_sales' table_name, '{column}' column_name, '{parent}' parent_table,"
        f" count(distinct {column}) unknown_keys, count(*) unknown_rows from fact_sales"
        f" where {column} is not null and {column} not in (select {key} from {source})"
        for column, parent, source, key in references
    )


def _not_null() -> str:
    return " union all ".join(
        f"select '{name}' table_name, '{c}' column_name,"
        f" (select count(*) from {_table(name)} where {c} is null) null_rows"
        for name, columns in ALL_COLUMNS.items()
        for c in (x.name for x in columns if x.needed)
    )


def _lengths() -> str:
    parts = []
    for name, columns in ALL_COLUMNS.items():
        for c in columns:
            if c.longest:
                size, bad = c.longest, f"length({c.name}) > {c.longest}"
            elif not c.digits:
                continue
            else:
                size, bad = c.digits, f"abs({c.name}) >= {10**c.digits}"
            parts.append(
                f"select '{name}' table_name, '{c.name}' column_name, {size} declared_size,"
                f" (select count(*) from {_table(name)} where {bad}) too_large_rows"
            )
    return " union all ".join(parts)


def _overview() -> str:
    return " union all ".join(
        f"select '{n}' dataset, count(*) row_count, {len(t)} column_count from stg_{n}"
        for n, t in RAW_COLUMNS.items()
    )


def _load_report() -> str:
    return " union all ".join(
        f"select '{n}' table_name, count(*) rows_loaded from {_table(n)}"
        for n in ALL_COLUMNS
    )


def _table_info() -> str:
    return " union all ".join(
        f"select '{name}' table_name, (select count(*) from stg_{name}) row_count, {i} as position,"
        f" '{c.name}' column_name, '{c.type}' data_type"
        for name in DESCRIBED
        for i, c in enumerate(RAW_COLUMNS[name], start=1)
    )


def _missing_parts(name: str) -> str:
    return " union all ".join(
        f"select '{c.name}' column_name, count(*) - count({c.name}) missing_count,"
        f" round_even(100.0::double * (count(*) - count({c.name})) / count(*), 2) missing_percentage"
        f" from stg_{name}"
        for c in RAW_COLUMNS[name]
    )


def _missing(name: str) -> str:
    return f"select * from ({_missing_parts(name)}) where missing_count > 0"


def _missing_summary() -> str:
    return " union all ".join(
        f"select '{name}' table_name, sum(missing_count)::bigint missing_cells,"
        f" count(*) filter (where missing_count > 0) columns_with_missing"
        f" from ({_missing_parts(name)})"
        for name in ("orders", "products")
    )


def _counts(table: str, column: str, limit: str = "") -> str:
    return (
        f"select {column}, count(*) cnt from stg_{table} where {column} is not null"
        f" group by {column} order by cnt desc, {column} {limit}"
    )


def _distinct(table: str, key: str, name: str) -> str:
    return f"(select count(distinct {key}) from stg_{table}) {name}"


def _coverage(child: str, parent: str, key: str, *names: str) -> str:
    pair = f"select {_distinct(child, key, names[0])}, {_distinct(parent, key, names[1])}"
    if len(names) == 2:
        return pair
    return f"select *, {names[1]} - {names[0]} as {names[2]} from ({pair})"


def _top_lines(dim: str, key: str, label: str) -> str:
    return (
        f"select {label}, count(*) sales_lines from fact_sales join {dim} using ({key})"
        f" group by {label} order by sales_lines desc, {label} limit 1"
    )


def expected_sql() -> dict[str, str]:
    bodies = {
        "dim_date": "select date_key, full_date from order_calendar",
        "profile_dim_date": _profile("dim_date", "order_calendar"),
        "order_calendar": "select date_key, full_date, strftime(first_purchase, '%Y-%m-%d %H:%M:%S') first_purchase,"
        " any_canceled::int any_canceled from order_calendar",
        "profile_order_calendar": _profile("order_calendar"),
        "dim_customer": "select * from dim_customer",
        "dim_seller": "select * from dim_seller",
        "dim_product": "select * from dim_product",
        "payment_per_order": "select * from payment_per_order",
        "review_per_order": "select * from review_per_order",
        "fact_sales": "select * from fact_sales",
        "sales_key_check": "select 1::bigint first_key, count(*) last_key, count(*) distinct_keys"
        " from fact_sales",
        "orphan_payments": _orphans("payments"),
        "orphan_order_items": _orphans("order_items"),
        "orphan_reviews": _orphans("reviews"),
        "inactive_sellers": _unreferenced(
            "sellers", "order_items", "seller_id", "inactive_sellers"
        ),
        "unsold_products": _unreferenced(
            "products", "order_items", "product_id", "unsold_products"
        ),
        "customers_without_orders": _unreferenced(
            "customers", "orders", "customer_id", "orphan_customers"
        ),
        "missing_zip": "select count(*) missing_zip_count from stg_customers"
        " where customer_zip_code_prefix is null",
        **{f"profile_{name}": _profile(name) for name in RAW},
        "profile_all": " union all ".join(_profile(name) for name in RAW),
        "pk_violations": _primary_keys(),
        "fk_violations": _foreign_keys("dim_date"),
        "fk_violations_default_calendar": _foreign_keys(
            "(select cast(strftime(d, '%Y%m%d') as int) date_key from generate_series("
            "timestamp '2016-01-01', timestamp '2021-01-01', interval '1' day) s(d))"
        ),
        "not_null_violations": _not_null(),
        "length_violations": _lengths(),
        "load_report": _load_report(),
        "dataset_overview": _overview(),
        "table_info": _table_info(),
        **{f"missing_{name}": _missing(name) for name in DESCRIBED},
        "missing_summary": _missing_summary(),
        "order_status_counts": _counts("orders", "order_status"),
        "top_states": _counts("customers", "customer_state", "limit 10"),
        "top_categories": _counts("products", "product_category_name", "limit 10"),
        "price_describe": "select count(v) as count, round(avg(v), 4) mean,"
        " round(stddev_samp(v), 4) std, round(min(v), 4) as min,"
        " round(quantile_cont(v, 0.25), 4) p25, round(quantile_cont(v, 0.5), 4) p50,"
        " round(quantile_cont(v, 0.75), 4) p75, round(max(v), 4) as max"
        " from (select price::double v from stg_order_items)",
        "items_per_order": "select round(avg(n), 2) avg_rows, max(n) max_rows"
        " from (select count(*) n from stg_order_items group by order_id)",
        "orders_without_items": _coverage(
            "order_items",
            "orders",
            "order_id",
            *("orders_with_items", "total_orders", "orders_without_items"),
        ),
        "products_never_sold": _coverage(
            "order_items",
            "products",
            "product_id",
            *("products_sold", "total_products", "products_never_sold"),
        ),
        "customers_with_orders": _coverage(
            "orders", "customers", "customer_id", "customers_with_orders", "total_customers"
        ),
        "active_sellers": _coverage(
            "order_items", "sellers", "seller_id", "active_sellers", "total_sellers"
        ),
        "order_key_coverage": _coverage(
            "order_items", "orders", "order_id", "order_ids_in_items", "order_ids_in_orders"
        ),
        "customer_key_check": "select count(*) total_rows,"
        " count(distinct customer_id) unique_customer_ids,"
        " count(distinct customer_unique_id) unique_customer_unique_ids from stg_customers",
        "kpi_revenue_lines": "select cast(sum(line_total) as decimal(28,2)) total_revenue,"
        " count(*) total_sales_lines from fact_sales",
        "kpi_orders": "select count(distinct order_id) total_orders from stg_orders",
        "kpi_top_category": _top_lines("dim_product", "product_sk", "category_en"),
        "kpi_top_state": _top_lines("dim_customer", "customer_sk", "customer_state"),
        "kpi_delivery": "select round(avg(days_to_deliver), 4) avg_days_line,"
        f" (select round(avg(d), 4) from {ORDER_GRAIN}) avg_days_order from fact_sales",
        "kpi_late_rate": "select round(sum(ll)::double / sum(dl), 4) late_rate_line,"
        f" round(sum(l)::double / sum(dd), 4) late_rate_order from {ORDER_GRAIN}",
        "kpi_values": "select round(sum(v)::double / sum(n), 4) avg_line_value,"
        f" round(sum(v)::double / count(*), 4) avg_order_value from {ORDER_GRAIN}",
        "revenue_by_category_state": "select category_en, customer_state,"
        " cast(sum(line_total) as decimal(28,2)) revenue, count(*) sales_lines,"
        " round(sum(is_late)::double / nullif(sum(is_delivered), 0), 4) late_rate"
        " from fact_sales join dim_product using (product_sk) join dim_customer using (customer_sk)"
        " group by category_en, customer_state",
        "revenue_by_month": "select purchase_date_key // 100 purchase_month, cast(sum(line_total) as decimal(28,2)) revenue,"
        " count(*) sales_lines, count(distinct order_id) orders,"
        " round(count(distinct order_id) filter (where is_late = 1)::double"
        " / nullif(count(distinct order_id) filter (where is_delivered = 1), 0), 4) late_rate"
        " from fact_sales group by purchase_date_key // 100",
    }
    return {name: f"WITH {STAGING_CTES}, {STAR_CTES} {sql}" for name, sql in bodies.items()}
