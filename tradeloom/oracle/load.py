"""Warehouse and mart loads."""

from __future__ import annotations

from tradeloom.oracle.tables import money, nearest

OPEN_VERSION = "'9999-12-31' as valid_to"


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, (select count(*) from {source}) as row_count" for name, source in tables.items()
    )


def _contact(kind: str, extra: str = "") -> str:
    return f"""
        select {kind}_id, company_name, contact_name, null::varchar as contact_title, null::varchar as address, city,
               {"region, postal_code" if kind == "customer" else "null::varchar as region, null::varchar as postal_code"},
               country, {"phone" if kind == "customer" else "null::varchar as phone"}{extra}
        from stg_{kind}s
    """


def _known(new: str, is_known: str, **columns: str) -> str:
    """Columns of an upserted row: the stored value for a known key, the staged one for a new key."""
    return ", ".join(f"case when {is_known} then {old} else {name} end as {name}" for name, old in columns.items()) + new


LOAD = {
    "stage_tables": _counts(
        {
            f"staging_{name}": source
            for name, source in {
                "customers": "customer", "employees": "stg_employees", "categories": "stg_categories",
                "suppliers": "supplier", "shippers": "stg_shippers", "products": "part", "orders": "orders",
                "order_details": "lineitem",
            }.items()
        }
    ),
    "dw_dim_date": """
        select date_id, d::varchar as date, day, mo as month, yr as year, quarter, week as week_of_year,
               isodow(d) as day_of_week, month_name, 'Q' || quarter as quarter_name, isodow(d) > 5 as is_weekend,
               (select count(*) from orders where o_orderdate::date = d) as order_count
        from dw_days
    """,
    "mart_dim_date": """
        select date_id, d::varchar as date, day, mo as month, yr as year, quarter, week as week_of_year,
               dayofweek(d) as day_of_week, rpad(dayname(d), 9, ' ') as day_name, month_name,
               dayname(d) in ('Saturday', 'Sunday') as is_weekend,
               d in (select o_orderdate::date from orders) as is_holiday
        from mart_days
    """,
    "dw_dim_customer": _contact("customer"),
    "dw_dim_supplier": _contact("supplier"),
    "dw_dim_employee": """
        select employee_id, last_name, first_name, title, null::varchar as birth_date, hire_date::varchar as hire_date,
               null::varchar as address, null::varchar as city, null::varchar as region, null::varchar as postal_code,
               null::varchar as country, null::varchar as home_phone, null::varchar as extension
        from stg_employees
    """,
    "dw_dim_category": "select category_id, category_name, null::varchar as description from stg_categories",
    "dw_dim_shipper": "select shipper_id::bigint as shipper_id, company_name, phone from stg_shippers",
    "dw_dim_product": f"""
        select product_id, product_name, supplier_id, category_id, quantity_per_unit,
               {money("list_cents")} as unit_price, units_in_stock, discontinued
        from dw_products
    """,
    "dw_fact_sales": f"""
        select date_id, customer_id, product_id, employee_id, category_id, ship_via::bigint as shipper_id, supplier_id,
               quantity as quantity_sold, {money("price_cents")} as unit_price, {money("discount_percent")} as discount,
               {money("total_cents")} as total_amount, {money("tax_cents")} as tax_amount
        from dw_sales
    """,
    "mart_upsert_supplier": f"""
        select supplier_id, company_name, contact_name, null::varchar as contact_title, null::varchar as address, city,
               null::varchar as region, null::varchar as postal_code,
               {_known(", ", "s_acctbal >= 0", country="'Elsewhere'", phone="'000'")}
               null::varchar as fax, true as is_active,
               case when s_acctbal >= 0 then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from (select *, null::varchar as phone from stg_suppliers)
    """,
    "mart_upsert_category": f"""
        select category_id, category_name, null::varchar as description,
               case when category_name < 'S' then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from stg_categories
    """,
    "mart_upsert_product": f"""
        select product_id, product_name, supplier_id, category_id, quantity_per_unit,
               {money("list_cents")} as unit_price, units_in_stock, units_on_order,
               {_known(", ", "p_size <= 40", reorder_level="5")}
               discontinued, true as is_current,
               case when p_size <= 40 then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from stg_products
    """,
    "mart_upsert_customer": f"""
        select customer_id, company_name, contact_name, null::varchar as contact_title, null::varchar as address, city,
               region, postal_code, country, {_known(", ", "c_acctbal >= 0", phone="'000'")}
               null::varchar as fax,
               case when c_acctbal >= 0 then 'Preferred' else 'Standard' end as customer_segment, true as is_active,
               case when c_acctbal >= 0 then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from stg_customers
    """,
    "mart_upsert_employee": f"""
        select employee_id, last_name, first_name, first_name || ' ' || last_name as full_name, title,
               null::varchar as title_of_courtesy, null::varchar as birth_date, hire_date::varchar as hire_date,
               null::varchar as address, null::varchar as city, null::varchar as region, null::varchar as postal_code,
               null::varchar as country, case when title is not null then '000' end as home_phone,
               null::bigint as reports_to, true as is_active,
               case when title is not null then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from stg_employees
    """,
    "mart_upsert_shipper": f"""
        select shipper_id::bigint as shipper_id, company_name, phone, company_name = 'MEDIUM' as is_active,
               case when company_name <> 'MEDIUM' then '1996-01-01' else '2001-12-31' end as valid_from, {OPEN_VERSION}
        from stg_shippers
    """,
    # Every stored product was cheaper, so each one is closed and reopened.
    "mart_scd2_product": f"""
        select product_id, product_name, supplier_id, category_id, quantity_per_unit,
               {money("list_cents")} as unit_price, units_in_stock::bigint as units_in_stock, units_on_order,
               reorder_level::bigint as reorder_level, discontinued, is_current, valid_from, valid_to
        from (
            select product_id, product_name, supplier_id, category_id, quantity_per_unit, list_cents, units_in_stock,
                   units_on_order, reorder_level, discontinued, false as is_current, '1996-01-01' as valid_from,
                   '2001-12-30' as valid_to
            from old_products
            union all
            select product_id, product_name, supplier_id, category_id, quantity_per_unit, list_cents, units_in_stock,
                   units_on_order, reorder_level, discontinued, true, '2001-12-31', '9999-12-31'
            from stg_products
        )
    """,
    "mart_fact_sales": f"""
        select date_id, customer_id, product_id, employee_id, category_id, ship_via::bigint as shipper_id, supplier_id,
               order_id, quantity as quantity_sold, {money("price_cents")} as unit_price,
               {money("discount_percent")} as discount, {money("total_cents")} as line_total,
               {money("tax_cents")} as tax_amount, {money("freight_share")} as freight_cost
        from mart_sales
    """,
    "mart_fact_sales_rejected": f"""
        select date_id, customer_id, product_id, employee_id, category_id, ship_via::bigint as shipper_id, supplier_id,
               order_id, quantity as quantity_sold, {money("price_cents")} as unit_price,
               {money("discount_percent")} as discount, {money(nearest("parts", "100"))} as line_total,
               {money(nearest("parts", "1000"))} as tax_amount,
               {money(nearest("freight_cents", "line_count"))} as freight_cost,
               case when discount_percent is null then 'discount is null'
                    when quantity <= 0 then 'violated: quantity_sold is positive'
                    else 'violated: discount is in 0..1' end as reason
        from mart_lines join line_counts using (order_id)
        where quantity <= 0 or discount_percent is null or discount_percent not between 0 and 100
    """,
    "mart_fact_supplier_purchases": f"""
        select supplier_id * 1000000 + date_id as purchase_id, supplier_id, date_id,
               {money("cents")} as total_purchase_amount, products as number_of_products,
               {money("avg_price_cents")} as average_unit_price, units::bigint as total_quantity
        from purchases
    """,
    "mart_fact_product_sales": f"""
        select date_id, product_id, category_id, supplier_id, units::bigint as quantity_sold,
               {money("cents")} as total_sales, {money("avg_price_cents")} as average_unit_price,
               orders as number_of_orders
        from product_days
    """,
    "mart_fact_customer_sales": f"""
        select date_id, customer_id, {money("cents")} as total_amount, units::bigint as total_quantity,
               orders as number_of_transactions, {money("avg_cents")} as average_transaction_value,
               tenure as days_since_first_purchase
        from customer_days
    """,
    "mart_fact_inventory": f"""
        select date_id, product_id, units_in_stock, units_on_order, reorder_level, {money("stock_cents")} as stock_value,
               is_low as is_below_reorder_level, supply::bigint as days_of_supply
        from inventory
    """,
    "mart_row_counts": _counts(
        {
            "dim_date": "mart_days", "dim_supplier": "stg_suppliers", "dim_category": "stg_categories",
            "dim_product": "stg_products", "dim_customer": "stg_customers", "dim_employee": "stg_employees",
            "dim_shipper": "stg_shippers", "fact_sales": "mart_sales", "fact_supplier_purchases": "purchases",
            "fact_product_sales": "product_days", "fact_customer_sales": "customer_days", "fact_inventory": "inventory",
        }
    ),
}
LOAD["mart_stored_upsert_customer"] = LOAD["mart_upsert_customer"]
for _name in ("fact_sales", "supplier_purchases", "product_sales", "customer_sales"):
    LOAD[f"mart_stored_{_name}"] = LOAD["mart_fact_" + _name.removeprefix("fact_")]
LOAD["mart_stored_fact_keys"] = """
    select load_run, n_rows, n_rows as n_keys, before + 1 as lowest_key, before + n_rows as highest_key
    from (select load_run, n_rows, (coalesce(sum(n_rows) over (order by load_run rows between unbounded preceding
                                                               and 1 preceding), 0))::bigint as before
          from (select case when d > date '1996-12-31' or d >= date '1996-12-01' and order_id % 7 = 0
                            then '2-late' else '1-early' end as load_run, count(*) as n_rows
                from mart_sales group by all))
"""
