"""Operational jobs, the constraint gate and text jobs."""

from __future__ import annotations

from tradeloom.oracle.tables import money, ratio

STAMP = "'2001-12-31 08:30:00'"
LATER = "'2002-01-01 09:15:00'"


def _decimal(cents: str) -> str:
    return f"(({cents}) / 100)::decimal(18,2)"


def _analytics(source: str, items: str, batch: str, at: str = STAMP) -> str:
    return f"""
        select order_id, customer_id, order_date::varchar as order_date, {money("cents")} as total_amount,
               {items} as item_count, null::double as avg_item_value, {at} as processing_timestamp,
               '{batch}' as processing_batch_id, 'PROCESSED' as status
        from {source}
    """


def _phones(digits: str) -> str:
    return f"""
        select customer_id, company_name, phone as original_phone,
               '(' || substr(ten, 1, 3) || ') ' || substr(ten, 4, 3) || '-' || substr(ten, 7) as formatted_phone
        from (
            select *, case when length(digits) > 10 then right(digits, 10) else rpad(digits, 10, '0') end as ten
            from (select *, {digits} as digits from stg_customers where phone is not null)
        )
    """


POSTAL_CLASS = r"""
    case when coalesce(trim(postal_code), '') = '' then 'Unknown'
         when regexp_full_match(regexp_replace(postal_code, '\s', '', 'g'), '\d{5}(-\d{4})?') then 'Local'
         when regexp_full_match(regexp_replace(postal_code, '\s', '', 'g'), '\d{3}-\d{3}') then 'National'
         else 'International' end
"""
ODD_CHARACTER = r"[^a-zA-Z0-9\s.\-_/:@#%&+=]"

# Rules per table of the constraint gate as (rule, number of violations).
_GATE: dict[str, list[tuple[str, str]]] = {}


def _rule(table: str, rule: str, count: str) -> None:
    _GATE.setdefault(table, []).append((rule, count))


def _where(table: str, source: str, rule: str, broken: str) -> None:
    _rule(table, rule, f"(select count(*) from {source} where {broken})")


def _required(table: str, source: str, columns: dict[str, str]) -> None:
    for name, column in columns.items():
        _where(table, source, f"{name} is required", f"{column} is null")


def _unique(table: str, source: str, columns: str, rule: str) -> None:
    _rule(table, rule, f"(select count(*) from {source}) - (select count(*) from (select distinct {columns} from {source}))")


def _lengths(table: str, source: str, limits: dict[str, int]) -> None:
    for name, limit in limits.items():
        _where(table, source, f"{name} has at most {limit} characters", f"length({name}) > {limit}")


def _exists(table: str, source: str, column: str, parent: str, parent_column: str, parent_name: str) -> None:
    lost = f"{column} is not null and {column} not in (select {parent_column} from {parent})"
    _where(table, source, f"{column} exists in {parent_name}", lost)


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


_required("staging_customers", "stg_customers", _same("customer_id", "company_name"))
_lengths("staging_customers", "stg_customers",
         {"company_name": 40, "city": 15, "region": 15, "postal_code": 10, "country": 15, "phone": 24})
_unique("staging_customers", "stg_customers", "customer_id", "customer_id is unique")
_required("staging_suppliers", "stg_suppliers", _same("supplier_id", "company_name"))
_lengths("staging_suppliers", "stg_suppliers", {"company_name": 40, "city": 15, "country": 15})
_unique("staging_suppliers", "stg_suppliers", "supplier_id", "supplier_id is unique")
_required("staging_categories", "stg_categories", _same("category_id", "category_name"))
_lengths("staging_categories", "stg_categories", {"category_name": 15})
_unique("staging_categories", "stg_categories", "category_id", "category_id is unique")
_required("staging_employees", "stg_employees", _same("employee_id", "last_name", "first_name", "title"))
_unique("staging_employees", "stg_employees", "employee_id", "employee_id is unique")
_required("staging_products", "stg_products", _same("product_id", "product_name", "discontinued"))
_lengths("staging_products", "stg_products", {"product_name": 40})
_where("staging_products", "stg_products", "unit_price in 0..", "list_cents < 0")
_where("staging_products", "stg_products", "units_in_stock in 0..", "units_in_stock < 0")
_unique("staging_products", "stg_products", "product_id", "product_id is unique")
_exists("staging_products", "stg_products", "supplier_id", "supplier", "s_suppkey", "staging_suppliers")
_exists("staging_products", "stg_products", "category_id", "stg_categories", "category_id", "staging_categories")
_required("staging_orders", "stg_orders", _same("order_id", "order_date"))
_where("staging_orders", "stg_orders", "order_date is in the mart calendar",
       "order_date not between date '1990-01-01' and date '2025-12-31'")
_where("staging_orders", "stg_orders", "order_date is in the warehouse calendar",
       "order_date not between date '1990-01-01' and date '2000-12-31'")
_unique("staging_orders", "stg_orders", "order_id", "order_id is unique")
_exists("staging_orders", "stg_orders", "customer_id", "stg_customers", "customer_id", "staging_customers")
_exists("staging_orders", "stg_orders", "employee_id", "events", "user_id", "staging_employees")
_exists("staging_orders", "stg_orders", "ship_via", "stg_shippers", "shipper_id", "staging_shippers")
_required("staging_order_details", "stg_details",
          {"unit_price": "price_cents", "quantity": "quantity", "discount": "discount_percent"})
_where("staging_order_details", "stg_details", "quantity is positive", "quantity <= 0")
_where("staging_order_details", "stg_details", "unit_price in 0..", "price_cents < 0")
_where("staging_order_details", "stg_details", "discount in 0..1", "discount_percent not between 0 and 100")
_unique("staging_order_details", "stg_details", "order_id, product_id", "order_id, product_id are unique")
_exists("staging_order_details", "stg_details", "order_id", "orders", "o_orderkey", "staging_orders")
_exists("staging_order_details", "stg_details", "product_id", "part", "p_partkey", "staging_products")
for _table, _source, _weekday, _low in (
    ("dw_dim_date", "dw_days", "isodow(d)", 1),
    ("mart_dim_date", "mart_days", "dayofweek(d)", 0),
):
    for _name, _column, _from, _to in (
        ("day", "day", 1, 31),
        ("month", "mo", 1, 12),
        ("quarter", "quarter", 1, 4),
        ("week_of_year", "week", 1, 53),
        ("day_of_week", _weekday, _low, _low + 6),
    ):
        _where(_table, _source, f"{_name} in {_from}..{_to}", f"{_column} not between {_from} and {_to}")
    _unique(_table, _source, "d", "date is unique")
_where("mart_dim_date", "mart_days", "year in 1900..2100", "yr not between 1900 and 2100")
# The mart's sales before the row checks; testdata breaks none of them.
_required("mart_fact_sales", "mart_lines",
          {"date_id": "date_id", "customer_id": "customer_id", "product_id": "product_id", "employee_id": "employee_id",
           "category_id": "category_id", "shipper_id": "ship_via", "supplier_id": "supplier_id", "order_id": "order_id",
           "quantity_sold": "quantity", "unit_price": "price_cents", "discount": "discount_percent",
           "line_total": "parts", "tax_amount": "parts", "freight_cost": "freight_cents"})
_where("mart_fact_sales", "mart_lines", "quantity_sold is positive", "quantity <= 0")
_where("mart_fact_sales", "mart_lines", "unit_price in 0..", "price_cents < 0")
_where("mart_fact_sales", "mart_lines", "discount in 0..1", "discount_percent not between 0 and 100")
for _name, _column in (("line_total", "parts"), ("tax_amount", "parts"), ("freight_cost", "freight_cents")):
    _where("mart_fact_sales", "mart_lines", f"{_name} in 0..", f"{_column} < 0")

OPERATIONS = {
    "order_totals": f"""
        select id as order_id, {money("coalesce(cents, 0)")} as order_total,
               id in (select o_orderkey from orders) as order_exists
        from (select o_orderkey as id from orders
              union all select o_orderkey + (select max(o_orderkey) + 1 from orders) from orders)
        left join order_sums on order_id = id
    """,
    "order_total_check": f"""
        select order_id, order_date::varchar as order_date, company_name, {money("coalesce(cents, 0)")} as order_total,
               if(cents > 0, 'VALID', 'CHECK') as validation
        from stg_orders join stg_customers using (customer_id) left join order_sums using (order_id)
    """,
    # One step of the recursion is one move of every product.
    "stock_movements_apply": """
        , steps as (
            select product_id, seq, quantity, units_in_stock, row_number() over (partition by product_id order by seq) as i
            from stock_moves join stg_products using (product_id) where quantity <> 0
        ), applied as (
            select product_id, seq, i, quantity, units_in_stock as stock_before,
                   greatest(0, units_in_stock + quantity) as stock_after
            from steps where i = 1
            union all
            select s.product_id, s.seq, s.i, s.quantity, a.stock_after, greatest(0, a.stock_after + s.quantity)
            from applied a join steps s on s.product_id = a.product_id and s.i = a.i + 1
        )
        select product_id, seq, stock_before::bigint as stock_before, quantity::bigint as quantity,
               stock_after::bigint as stock_after,
               if(quantity > 0, 'STOCK_ADDITION', 'STOCK_REDUCTION') as operation
        from applied
    """,
    "stock_movements_rejected": """
        select m.product_id, seq,
               case when p.product_id is null then 'product not found' else 'quantity is null' end as reason
        from stock_moves m left join stg_products p using (product_id)
        where (p.product_id is null and (quantity is null or quantity <> 0)) or (p.product_id is not null and quantity is null)
    """,
    "stock_status_report": f"""
        select product_id, product_name, units_in_stock as final_stock, reorder_level,
               if(units_in_stock > reorder_level, 'STOCK OK', 'REORDER NEEDED') as stock_status,
               {money("list_cents")} as unit_price, {money("units_in_stock * list_cents")} as stock_value
        from stg_products
    """,
    "price_audit_log": f"""
        select product_id, product_name, category_id, {money("old_cents")} as old_price, {money("new_cents")} as new_price,
               {money("new_cents - old_cents")} as price_change, {money("change_hundredths")} as change_percentage,
               operation_type, 'etl' as updated_by, {STAMP} as updated_at,
               case operation_type
                    when 'INSERT' then '{{"action":"initial_price_set","session_user":"etl","current_time":"2001-12-31 08:30:00"}}'
                    when 'DELETE' then '{{"action":"product_removal","session_user":"etl"}}'
                    else '{{"action":"price_adjustment","price_difference":' || {_decimal("new_cents - old_cents")}
                         || ',"session_user":"etl"}}' end as session_info
        from price_log
    """,
    "price_audit_listing": f"""
        select row_number() over (order by product_id) as log_id, product_id, product_name,
               {money("old_cents")} as old_price, {money("new_cents")} as new_price,
               {money("new_cents - old_cents")} as price_change, {_decimal("change_hundredths")} || '%' as change_pct,
               operation_type, 'etl' as updated_by, {STAMP} as updated_time,
               case operation_type when 'INSERT' then 'initial_price_set' when 'DELETE' then 'product_removal'
                    else 'price_adjustment' end as audit_action
        from price_log
    """,
    "price_change_summary": f"""
        select product_id, product_name, count(*) as change_count, {money("min(old_cents)")} as min_old_price,
               {money("max(new_cents)")} as max_new_price, {money("sum(new_cents - old_cents)")} as total_change,
               {ratio("sum(change_hundredths)", "count(change_hundredths)")} as avg_change_pct,
               '2001-12-31' as first_change, '2001-12-31' as last_change
        from price_log group by product_id, product_name
    """,
    # The stored price is step -1 of its product; each step is compared with the one before.
    "price_feed_log": f"""
        , steps as (
            select product_id, -1 as seq, product_name, category_id, list_cents as cents, false as removed, null::timestamp as at_time
            from stg_products
            union all
            select moved_product, event_id, 'after ' || event_type, null, round(value * 100)::bigint,
                   event_type = 'error', ts
            from event_products
        ), chained as (
            select *, lag(if(removed, null, cents)) over w as old_cents, lag(product_name) over w as old_name,
                   lag(category_id) over w as old_category, if(removed, null, cents) as new_cents
            from steps window w as (partition by product_id order by seq)
        )
        select product_id, seq::bigint as seq, if(old_cents is null, product_name, old_name) as product_name,
               if(old_cents is null, category_id, old_category)::bigint as category_id,
               {money("coalesce(old_cents, 0)")} as old_price, {money("coalesce(new_cents, 0)")} as new_price,
               {money("coalesce(new_cents, 0) - coalesce(old_cents, 0)")} as price_change,
               case when old_cents > 0
                    then {ratio("(coalesce(new_cents, 0) - old_cents) * 10000", "old_cents")} end as change_percentage,
               case when old_cents is null then 'INSERT' when new_cents is null then 'DELETE' else 'UPDATE' end
               as operation_type,
               'etl' as updated_by, strftime(at_time, '%Y-%m-%d %H:%M:%S') as updated_at,
               case when old_cents is null
                    then '{{"action":"initial_price_set","session_user":"etl","current_time":"'
                         || strftime(at_time, '%Y-%m-%d %H:%M:%S') || '"}}'
                    when new_cents is null then '{{"action":"product_removal","session_user":"etl"}}'
                    else '{{"action":"price_adjustment","price_difference":' || {_decimal("new_cents - old_cents")}
                         || ',"session_user":"etl"}}' end as session_info
        from chained
        where seq >= 0 and old_cents is distinct from new_cents
    """,
    "order_analytics_batch": _analytics(
        "(select * from batch_rows order by order_date desc, items desc, order_id limit 15)", "items", "batch-orders"
    ),
    "order_analytics_batch_whole_period": _analytics("batch_rows", "items", "batch-orders"),
    "order_analytics_batch_progress": f"""
        select count(*) as records_processed, {money("sum(cents)")} as total_amount,
               {ratio("sum(cents)", "count(*)")} as average_order
        from batch_rows
    """,
    "order_analytics_bulk": _analytics(
        "(select * from bulk_rows order by order_date, order_id limit 20)", "null::bigint", "bulk-orders"
    ),
    "order_analytics_bulk_rerun": _analytics("bulk_rows", "null::bigint", "bulk-orders", LATER),
    "analytics_batch_summary": f"""
        select batch_id, count(*) as orders_processed, strftime(min(processed_at), '%Y-%m-%d %H:%M:%S') as started_at,
               strftime(max(processed_at), '%Y-%m-%d %H:%M:%S') as completed_at, {money("sum(cents)")} as total_volume,
               {ratio("sum(cents)", "count(*)")} as avg_order_value, {money("max(cents)")} as largest_order,
               {money("min(cents)")} as smallest_order
        from analytics group by batch_id
    """,
    "analytics_customer_summary": f"""
        select customer_id, count(*) as order_count, {money("sum(cents)")} as total_spent,
               {ratio("sum(cents)", "count(*)")} as avg_order_value,
               {ratio("sum(cents)", "count(*)")} as customer_lifetime_value
        from analytics where customer_id is not null
        group by customer_id order by sum(cents) desc, customer_id limit 10
    """,
    "analytics_overall": f"""
        select count(*) as total_records_processed, strftime(min(processed_at), '%Y-%m-%d') as first_processing_date,
               strftime(max(processed_at), '%Y-%m-%d') as last_processing_date, {money("sum(cents)")} as total_processed_value
        from analytics
    """,
    "dq_constraint_gate": " union all ".join(
        f"select '{table}' as table_name, '{rule}' as rule, {count} as violations"
        for table, rules in _GATE.items()
        for rule, count in rules
    ),
    "homepage_audit": f"""
        select supplier_id, company_name, homepage from stg_suppliers where regexp_matches(homepage, '{ODD_CHARACTER}')
    """,
    "page_url_audit": f"select page_id, url from pages where regexp_matches(url, '{ODD_CHARACTER}')",
    "phone_standardize": _phones("regexp_replace(phone, '[^0-9]', '')"),
    "phone_standardize_corrected": _phones("regexp_replace(phone, '[^0-9]', '', 'g')"),
    "postal_classes": f"select customer_id, postal_code, {POSTAL_CLASS} as postal_class from stg_customers",
    "postal_segments": f"""
        select {POSTAL_CLASS} as postal_class, count(*) as customer_count,
               {money("sum(coalesce(cents, 0))")} as total_revenue
        from stg_customers
        left join (select customer_id, sum(total_cents) as cents from dw_sales group by customer_id) using (customer_id)
        group by 1
    """,
    "product_name_gate": """
        select product_id, if(reason is null, trim(typed), typed) as product_name, reason
        from (
            select product_id, typed,
                   case when typed is null then 'Product name cannot be NULL'
                        when length(trim(typed)) < 5
                        then 'Product name must be at least 5 characters long (after trimming)'
                        when not regexp_matches(trim(typed), '^[A-Z]')
                        then 'Product name must start with an uppercase letter (A-Z)' end as reason
            from (
                select p_partkey as product_id, upper(left(p_name, 1)) || substr(p_name, 2) as capital,
                       case when p_size = 50 then null when p_size % 4 = 0 then capital when p_size % 4 = 1 then p_name
                            when p_size % 4 = 2 then '   ' || capital || '  ' else left(capital, 6) end as typed
                from part
            )
        )
    """,
}
OPERATIONS["dq_routed_order_details"] = " union all ".join(
    f"select '{rule}' as rule, {count} as violations, {count} as stored_rows" for rule, count in _GATE["staging_order_details"]
)
