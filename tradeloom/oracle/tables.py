"""Shared subqueries: staging, dimensions, facts and small SQL helpers."""

from __future__ import annotations

CALENDAR_PARTS = """
    date_diff('day', date '1990-01-01', d) + 1 as date_id, d,
    day(d) as day, month(d) as mo, year(d) as yr, quarter(d) as quarter, weekofyear(d) as week,
    rpad(monthname(d), 9, ' ') as month_name
"""


def money(cents: str) -> str:
    """Cents as a double amount."""
    return f"(cast({cents} as double) / 100)"


def nearest(n: str, d: str) -> str:
    """Integer nearest to n / d for a positive d, halves away from zero."""
    return f"(sign({n}) * ((2 * abs({n}) + ({d})) // (2 * ({d}))))"


def ratio(n: str, d: str) -> str:
    """n / d at two decimals; n is given in hundredths."""
    return money(nearest(n, f"nullif({d}, 0)"))


def growth(current: str, previous: str) -> str:
    return ratio(f"(({current}) - ({previous})) * 10000", previous)


TABLES = {
    "stg_customers": """
        select c_custkey as customer_id, c_name as company_name, 'Contact ' || c_custkey as contact_name,
               'City_' || (c_custkey % 40) as city,
               case when c_custkey % 11 = 0 then null else 'R' || (c_custkey % 3) end as region,
               n_name as country,
               case c_custkey % 7
                    when 0 then lpad(c_custkey::varchar, 5, '0')
                    when 1 then lpad(c_custkey::varchar, 5, '0') || '-1234'
                    when 2 then '123-456' when 3 then 'k1a 0b1' when 4 then 'SW1A 1AA' when 5 then '   '
               end as postal_code,
               case c_custkey % 4
                    when 0 then '(' || lpad(((c_custkey * 37) % 1000)::varchar, 3, '0') || ') 555-'
                                || lpad((c_custkey % 10000)::varchar, 4, '0')
                    when 1 then '+49 30 ' || lpad(c_custkey::varchar, 9, '1')
                    when 2 then '0921-12 ' || (c_custkey % 10)
               end as phone,
               c_acctbal
        from customer join nation on c_nationkey = n_nationkey
    """,
    "stg_suppliers": """
        select s_suppkey as supplier_id, s_name as company_name, 'Agent ' || s_suppkey as contact_name,
               'City_' || (s_suppkey % 40) as city, n_name as country,
               case s_suppkey % 4 when 0 then null
                    when 1 then 'http://www.s' || s_suppkey || '.example/(shop)'
                    else 'http://www.s' || s_suppkey || '.example/' end as homepage,
               s_acctbal
        from supplier join nation on s_nationkey = n_nationkey
    """,
    "stg_categories": """
        select dense_rank() over (order by p_type) as category_id, p_type as category_name
        from (select distinct p_type from part)
    """,
    "stg_products": """
        select p_partkey as product_id, p_name as product_name,
               p_partkey % (select count(*) from supplier) as supplier_id, category_id,
               p_size || ' units' as quantity_per_unit, round(p_retailprice * 100)::bigint as list_cents,
               (p_partkey * 37) % 2000 as units_in_stock, (p_partkey * 3) % 40 as units_on_order,
               (p_partkey % 6) * 100 as reorder_level, p_partkey % 10 = 0 as discontinued, p_size
        from part join stg_categories on p_type = category_name
    """,
    "stg_employees": """
        select user_id as employee_id, 'Last_' || user_id as last_name, 'First_' || (user_id % 20) as first_name,
               case when user_id % 13 <> 0 then 'Sales Representative' end as title,
               min(ts)::date as hire_date
        from events group by user_id
    """,
    "stg_shippers": """
        select distinct left(o_orderpriority, 1)::int as shipper_id, substr(o_orderpriority, 3) as company_name,
               '555-000' || left(o_orderpriority, 1) as phone
        from orders
    """,
    "stg_orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
               o_orderkey % (select count(distinct user_id) from events) as employee_id,
               o_orderdate::date as order_date, left(o_orderpriority, 1)::int as ship_via,
               (o_orderkey % 500 + 5) * 100 as freight_cents
        from orders
    """,
    "stg_details": """
        select case when kind = 5 then -1 - order_id else order_id end as order_id,
               case when kind = 4 then -1 - product_id else product_id end as product_id,
               case when kind = 1 then 0 else quantity end as quantity,
               case kind when 3 then 110 when 2 then null else discount_percent end as discount_percent,
               (2 * line_cents + quantity) // nullif(2 * quantity, 0) as price_cents
        from (select l_orderkey as order_id, l_partkey as product_id, l_quantity::bigint as quantity,
                     round(l_extendedprice * 100)::bigint as line_cents,
                     round(l_discount * 100)::bigint as discount_percent,
                     (l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 997 as kind
              from lineitem)
    """,
    "dw_days": f"""
        select {CALENDAR_PARTS}
        from (select unnest(generate_series(date '1990-01-01', date '2000-12-31', interval 1 day))::date as d)
    """,
    "mart_days": f"""
        select {CALENDAR_PARTS}
        from (select unnest(generate_series(date '1990-01-01', date '2025-12-31', interval 1 day))::date as d)
    """,
    "dw_products": """
        select * from stg_products
        where supplier_id in (select supplier_id from stg_suppliers)
          and category_id in (select category_id from stg_categories)
    """,
    # parts is the line value in hundredths of a cent
    "dw_sales": """
        select date_id, d, yr, mo, month_name, week, customer_id, product_id, employee_id, category_id, ship_via,
               supplier_id, quantity, price_cents, discount_percent,
               (parts + 50) // 100 as total_cents, (parts + 500) // 1000 as tax_cents, parts
        from (select *, quantity * price_cents * (100 - discount_percent) as parts
              from (select * replace (coalesce(discount_percent, 0) as discount_percent) from stg_details))
        join stg_orders using (order_id)
        join dw_products using (product_id)
        join dw_days on order_date = d
        where quantity > 0 and price_cents >= 0 and discount_percent between 0 and 100
          and customer_id in (select customer_id from stg_customers)
    """,
    "mart_lines": """
        select date_id, d, yr, mo, order_id, order_date, customer_id, product_id, employee_id, category_id, ship_via,
               supplier_id, quantity, price_cents, discount_percent, freight_cents,
               quantity * price_cents * (100 - discount_percent) as parts
        from stg_details
        join stg_orders using (order_id)
        join stg_products using (product_id)
        join mart_days on order_date = d
    """,
    "line_counts": "select order_id, count(*) as line_count from stg_details group by order_id",
    "mart_sales": f"""
        select *, (parts + 50) // 100 as total_cents, (parts + 500) // 1000 as tax_cents,
               {nearest("freight_cents", "line_count")} as freight_share
        from mart_lines join line_counts using (order_id)
        where quantity > 0 and price_cents >= 0 and discount_percent between 0 and 100
    """,
    "purchases": f"""
        select supplier_id, date_id, yr, mo, {nearest("sum(parts)", "100")} as cents, count(distinct product_id) as products,
               {nearest("sum(price_cents)", "count(*)")} as avg_price_cents, sum(quantity) as units
        from mart_lines group by supplier_id, date_id, yr, mo having sum(parts) is not null
    """,
    "product_days": f"""
        select date_id, product_id, category_id, supplier_id, sum(quantity) as units, {nearest("sum(parts)", "100")} as cents,
               {nearest("sum(price_cents)", "count(*)")} as avg_price_cents, count(distinct order_id) as orders
        from mart_lines group by all having sum(parts) is not null
    """,
    "customer_lines": """
        select date_id, order_date, order_id, customer_id, quantity,
               quantity * price_cents * (100 - discount_percent) as parts
        from stg_details join stg_orders using (order_id) join mart_days on order_date = d
    """,
    "first_orders": "select customer_id, min(order_date) as first_day from customer_lines group by customer_id",
    "customer_days": f"""
        select date_id, customer_id, {nearest("sum(parts)", "100")} as cents, sum(quantity) as units,
               count(distinct order_id) as orders, {nearest("sum(parts)", "100 * count(parts)")} as avg_cents,
               date_diff('day', any_value(first_day), any_value(order_date)) as tenure
        from customer_lines join first_orders using (customer_id)
        group by date_id, customer_id having sum(parts) is not null
    """,
    "sold": "select product_id, sum(quantity) as units, count(*) as lines from stg_details group by product_id",
    "inventory": f"""
        select p.*, units_in_stock * list_cents as stock_cents, units_in_stock <= reorder_level as is_low,
               case when units > 0 then {nearest("units_in_stock * lines", "units")} end as supply,
               (select date_id from mart_days where d = date '2001-12-31') as date_id
        from stg_products p left join sold using (product_id)
    """,
    "order_sums": f"""
        select order_id, sum({nearest("quantity * price_cents * (100 - coalesce(discount_percent, 0))", "100")}) as cents,
               count(*) as items
        from stg_details group by order_id
    """,
    "event_products": """
        select *, case when event_id % 3 = 0 then event_id % 10 else event_id % ((select count(*) from part) + 3) end
                  as moved_product
        from events
    """,
    "stock_moves": """
        select event_id as seq, moved_product as product_id,
               case when event_id % 211 <> 7 then floor(value)::int % 41 - 20 end as quantity
        from event_products
    """,
    "products_after": """
        select product_id, product_name, category_id,
               case product_id % 10 when 3 then (list_cents * 115 + 50) // 100
                                    when 4 then list_cents + 50 else list_cents end as list_cents
        from stg_products where product_id % 50 <> 7
        union all
        select product_id + 1 + (select max(p_partkey) from part), product_name || ' new', category_id, list_cents
        from stg_products where product_id % 100 = 9
    """,
    "price_log": f"""
        select coalesce(b.product_id, a.product_id) as product_id,
               case when b.product_id is null then a.product_name else b.product_name end as product_name,
               case when b.product_id is null then a.category_id else b.category_id end as category_id,
               coalesce(b.list_cents, 0) as old_cents, coalesce(a.list_cents, 0) as new_cents,
               case when b.product_id is null then 'INSERT' when a.product_id is null then 'DELETE'
                    else 'UPDATE' end as operation_type,
               case when b.list_cents > 0
                    then {nearest("(coalesce(a.list_cents, 0) - b.list_cents) * 10000", "b.list_cents")}
               end as change_hundredths
        from stg_products b full join products_after a on a.product_id = b.product_id
        where b.product_id is null or a.product_id is null or a.list_cents <> b.list_cents
    """,
    "batch_rows": """
        select order_id, customer_id, order_date, coalesce(cents, 0) as cents, coalesce(items, 0) as items
        from stg_orders join stg_customers using (customer_id) left join order_sums using (order_id)
        where year(order_date) = 1997
    """,
    "bulk_rows": """
        select order_id, customer_id, order_date, coalesce(cents, 0) as cents
        from stg_orders left join order_sums using (order_id)
        where order_date >= date '1997-01-01' and order_date < date '1997-04-01'
    """,
    "analytics": """
        select order_id, customer_id, cents, timestamp '2001-12-31 08:30:00' as processed_at, 'batch-orders' as batch_id
        from batch_rows
        union all
        select order_id, customer_id, cents, timestamp '2002-01-01 09:15:00', 'bulk-orders' from bulk_rows
    """,
    "old_products": """
        select product_id, product_name, supplier_id, category_id, quantity_per_unit, list_cents - 100 as list_cents,
               0 as units_in_stock, units_on_order, 5 as reorder_level, discontinued
        from stg_products where p_size <= 40
    """,
}
