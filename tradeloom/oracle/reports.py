"""Warehouse and mart reports."""

from __future__ import annotations

from tradeloom.oracle.tables import growth, money, nearest, ratio


def _bands(value: str, first: int, rest: list[int], labels: list[str]) -> str:
    cases = [f"when {value} > {first} then '{labels[0]}'"]
    cases += [f"when {value} >= {bound} then '{label}'" for bound, label in zip(rest, labels[1:-1], strict=True)]
    return f"case {' '.join(cases)} else '{labels[-1]}' end"


def _scorecard(copies: str, first: int, rest: list[int]) -> str:
    tier = _bands("cents", first * 100, [bound * 100 for bound in rest],
                  ["Strategic Partner", "Key Supplier", "Preferred Supplier", "Standard Supplier"])
    return f"""
        select supplier, country, {money("cents")} as total_spend, rank() over (order by cents desc) as spend_rank,
               units::bigint as total_units, {ratio("price_sum", "days")} as avg_price,
               product_count::bigint as product_count, {tier} as supplier_tier
        from (
            select company_name as supplier, country, sum(cents * {copies}) as cents, sum(units * {copies}) as units,
                   sum(avg_price_cents * {copies}) as price_sum, sum({copies}) as days, any_value(n) as product_count
            from purchases
            join stg_suppliers using (supplier_id)
            join (select supplier_id, count(*) as n from stg_products group by supplier_id) using (supplier_id)
            group by company_name, country
        )
    """


def _lifetime(first: int, rest: list[int]) -> str:
    tier = _bands("cents", first * 100, [bound * 100 for bound in rest], ["Platinum", "Gold", "Silver", "Bronze"])
    return f"""
        select customer, country, 'Standard' as segment, {money("cents")} as ltv,
               rank() over (order by cents desc) as ltv_rank, orders::bigint as transactions,
               {ratio("avg_sum", "days")} as avg_order_value, tenure_days, {tier} as value_tier
        from (
            select company_name as customer, country, sum(cents) as cents, sum(orders) as orders,
                   sum(avg_cents) as avg_sum, count(*) as days, max(tenure) as tenure_days
            from customer_days join stg_customers using (customer_id)
            group by company_name, country
        )
    """


def _employees(first: int, rest: list[int]) -> str:
    labels = ["Top Performer", "Strong Performer", "Solid Performer", "Developing"]
    return f"""
        select full_name, title, hire_date::varchar as hire_date, orders as total_orders, units::bigint as total_units_sold,
               {money("cents")} as total_sales, {ratio("cents", "lines")} as avg_order_value,
               {money("(cents * 5 + 50) // 100")} as estimated_commission,
               rank() over (order by cents desc) as sales_rank,
               {_bands("cents", first * 100, [bound * 100 for bound in rest], labels)} as performance_category
        from (
            select employee_id, first_name || ' ' || last_name as full_name, title, hire_date,
                   count(distinct order_id) as orders, sum(quantity) as units, sum(total_cents) as cents, count(*) as lines
            from mart_sales join stg_employees using (employee_id) group by all
        )
    """


def _links(min_orders: int) -> str:
    return f"""
        select s.company_name as supplier, category_name, c.company_name as customer,
               count(distinct order_id) as shared_transactions, sum(quantity)::bigint as total_units,
               {money("sum(total_cents)")} as total_revenue, {ratio("sum(price_cents)", "count(*)")} as avg_unit_price
        from mart_sales
        join stg_suppliers s using (supplier_id)
        join stg_categories using (category_id)
        join stg_customers c using (customer_id)
        group by s.company_name, category_name, c.company_name
        having count(distinct order_id) >= {min_orders}
        order by sum(total_cents) desc, supplier, category_name, customer
        limit 20
    """


def _score(expected_parts: str, stored_parts: str) -> str:
    """No fact row can lack a dimension or break a range: both were filters of the load."""
    return f"""
        select {ratio("points * 100", "n")} as total_quality_score, 40.0::double as completeness, 30.0::double as validity,
               {ratio("(n - off) * 3000", "n")} as consistency,
               case when points >= 95 * n then 'Excellent' when points >= 85 * n then 'Good'
                    when points >= 75 * n then 'Fair' else 'Poor' end as quality_rating
        from (select *, 70 * n + 30 * (n - off) as points
              from (select count(*) as n, count(*) filter ({stored_parts} <> {expected_parts}) as off from dw_sales))
    """


REPORTS = {
    "dw_monthly_category_trend": f"""
        select yr as year, mo as month, month_name, category_name, n as transaction_count,
               units::bigint as total_quantity_sold, {ratio("cents", "n")} as avg_sales_amount,
               {money("cents")} as total_sales_amount, {money("previous")} as previous_month_sales,
               {growth("cents", "previous")} as sales_growth_percent
        from (
            select *, lag(cents) over (partition by category_name order by yr, mo) as previous
            from (select yr, mo, month_name, category_name, count(*) as n, sum(quantity) as units,
                         sum(total_cents) as cents
                  from dw_sales join stg_categories using (category_id)
                  where mo <= 3 group by all)
        )
    """,
    "dw_top_products_monthly": f"""
        select yr as year, mo as month, product_name, category_name, n as transaction_count,
               {money("cents")} as total_sales, {money("tax")} as total_tax, {ratio("cents", "n")} as avg_transaction_value,
               by_count as transaction_rank, by_value as sales_rank,
               case when greatest(by_count, by_value) <= 5 then 'Top in Both'
                    when by_count <= 5 then 'Top in Transactions' else 'Top in Sales' end as performance_category
        from (
            select *, rank() over (partition by yr, mo order by n desc) as by_count,
                   rank() over (partition by yr, mo order by cents desc) as by_value
            from (select yr, mo, product_id, count(*) as n, sum(total_cents) as cents, sum(tax_cents) as tax
                  from dw_sales group by all)
        )
        join stg_products using (product_id) join stg_categories using (category_id)
        where least(by_count, by_value) <= 5
    """,
    "dw_top_customers": f"""
        select customer_id, company_name, country, city, n as transaction_count, {money("cents")} as total_purchase_amount,
               {ratio("cents", "n")} as avg_transaction_value, kinds as unique_categories_purchased,
               last_day::varchar as last_purchase_date, by_count as transaction_rank, by_value as purchase_rank,
               {money(nearest("n * 400 + cents * 6", "1000"))} as customer_value_score
        from (
            select *, rank() over (order by n desc) as by_count, rank() over (order by cents desc) as by_value
            from (select customer_id, count(*) as n, sum(total_cents) as cents, count(distinct category_id) as kinds,
                         max(d) as last_day
                  from dw_sales group by customer_id)
        )
        join stg_customers using (customer_id)
        where least(by_count, by_value) <= 5
        order by customer_value_score desc, cents desc, customer_id
        limit 10
    """,
    "dw_first_week_sales": f"""
        select yr as year, mo as month, month_name, week as first_week, n as transaction_count,
               units::bigint as total_quantity_sold, {money("cents")} as total_sales_amount,
               {money("tax")} as total_tax_amount, {ratio("cents", "n")} as avg_transaction_value,
               {money("previous")} as previous_year_same_month_sales,
               {growth("cents", "previous")} as year_over_year_growth,
               case sign({nearest("(cents - previous) * 10000", "previous")})
                    when 1 then 'Growth' when -1 then 'Decline' else 'Stable' end as growth_status
        from (
            select *, lag(cents) over (partition by mo order by yr) as previous
            from (
                select yr, mo, month_name, week, count(*) as n, sum(quantity) as units, sum(total_cents) as cents,
                       sum(tax_cents) as tax
                from dw_sales
                where (yr, mo, week) in (select yr, mo, min(week) from dw_days group by yr, mo)
                group by all
            )
        )
    """,
    "dw_weekly_category_sales": f"""
        select 1997::bigint as year, w.mo as month, month_name, week as week_of_year, category_name,
               w.n as weekly_transactions, w.units::bigint as weekly_quantity, {money("w.cents")} as weekly_sales,
               {money("w.tax")} as weekly_tax, m.n as monthly_transactions, m.units::bigint as monthly_quantity,
               {money("m.cents")} as monthly_sales, {money("m.tax")} as monthly_tax,
               {ratio("w.cents * 10000", "m.cents")} as weekly_contribution_percent,
               {money("sum(w.cents) over (partition by w.mo, category_name order by week)")} as running_monthly_sales
        from (select mo, month_name, week, category_id, count(*) as n, sum(quantity) as units, sum(total_cents) as cents,
                     sum(tax_cents) as tax from dw_sales where yr = 1997 group by all) w
        join (select mo, category_id, count(*) as n, sum(quantity) as units, sum(total_cents) as cents,
                     sum(tax_cents) as tax from dw_sales where yr = 1997 group by all) m
          on m.mo = w.mo and m.category_id = w.category_id
        join stg_categories k on k.category_id = w.category_id
    """,
    "dw_median_sales": f"""
        select category_name, country, n as monthly_periods, {money("low")} as min_monthly_sales,
               {money("high")} as max_monthly_sales, {money("average")} as avg_monthly_sales,
               {money("median")} as median_sales, {money("q1")} as first_quartile, {money("q3")} as third_quartile,
               {money("q3 - q1")} as inter_quartile_range,
               case when abs(average - median) * 10 > median then 'Skewed' else 'Symmetric' end as distribution_type
        from (
            select category_name, country, count(*) as n, min(cents) as low, max(cents) as high,
                   {nearest("sum(cents)", "count(*)")} as average,
                   floor(quantile_cont(cents::double, 0.25) + 0.5)::bigint as q1,
                   floor(quantile_cont(cents::double, 0.5) + 0.5)::bigint as median,
                   floor(quantile_cont(cents::double, 0.75) + 0.5)::bigint as q3
            from (select category_name, country, yr, mo, sum(total_cents) as cents
                  from dw_sales join stg_categories using (category_id) join stg_customers using (customer_id)
                  group by all having sum(total_cents) > 0)
            group by category_name, country having count(*) >= 3
        )
    """,
    "dw_category_ranking": f"""
        select category_name, n as total_transactions, units::bigint as total_quantity_sold,
               {money("cents")} as total_sales_amount, {money("tax")} as total_tax_amount, buyers as unique_customers,
               goods as unique_products, {ratio("cents", "n")} as avg_transaction_value, by_value as sales_rank,
               by_count as transaction_rank, by_buyers as customer_rank,
               {money(nearest("(by_value * 5 + by_count * 3 + by_buyers * 2) * 100", "30"))} as performance_score,
               case when by_value = 1 then 'Top Seller' when by_value < 4 then 'High Performer'
                    when by_value < 6 then 'Medium Performer' else 'Low Performer' end as performance_category,
               {ratio("cents * 10000", "whole")} as market_share_percent
        from (
            select *, rank() over (order by cents desc) as by_value, rank() over (order by n desc) as by_count,
                   rank() over (order by buyers desc) as by_buyers, sum(cents) over () as whole
            from (select category_id, count(*) as n, sum(quantity) as units, sum(total_cents) as cents,
                         sum(tax_cents) as tax, count(distinct customer_id) as buyers,
                         count(distinct product_id) as goods
                  from dw_sales group by category_id)
        ) join stg_categories using (category_id)
    """,
    "dw_rfm_segments": f"""
        select customer_id, company_name, country, recency, frequency, {money("cents")} as monetary, r as r_score,
               f as f_score, m as m_score, r + f + m as rfm_total,
               case when least(r, f, m) > 3 then 'Champions' when least(r, f, m) > 2 then 'Loyal Customers'
                    when least(r, f) > 1 then 'Potential Loyalists' when r > 2 and f < 3 then 'New Customers'
                    when r < 3 and f > 2 then 'At Risk' else 'Lost Customers' end as customer_segment
        from (
            select *, ntile(5) over (order by recency desc, customer_id) as r,
                   ntile(5) over (order by frequency, customer_id) as f, ntile(5) over (order by cents, customer_id) as m
            from (select customer_id, date_diff('day', max(d), date '2001-12-31') as recency, count(*) as frequency,
                         sum(total_cents) as cents
                  from dw_sales group by customer_id)
        ) join stg_customers using (customer_id)
    """,
    "mart_supplier_scorecard": _scorecard("n", 100000, [50000, 10000]),
    "mart_supplier_scorecard_corrected": _scorecard("1", 60000000, [30000000, 15000000]),
    "mart_supplier_monthly_trend": f"""
        select yr as year, mo as month, supplier, {money("cents")} as monthly_spend,
               {money("previous")} as previous_month_spend, {growth("cents", "previous")} as monthly_growth_percent
        from (
            select *, lag(cents) over (partition by supplier order by yr, mo) as previous
            from (select yr, mo, company_name as supplier, sum(cents) as cents
                  from purchases join stg_suppliers using (supplier_id) group by all)
        )
    """,
    "mart_product_dashboard": f"""
        select product_name, category_name, supplier, units::bigint as total_units_sold, {money("cents")} as total_revenue,
               {ratio("price_sum", "days")} as avg_selling_price, orders::bigint as order_count,
               rank() over (order by cents desc) as revenue_rank,
               {_bands("units", 1000, [500], ["High Demand", "Medium Demand", "Low Demand"])} as demand_category
        from (
            select product_name, category_name, company_name as supplier, sum(units) as units, sum(cents) as cents,
                   sum(avg_price_cents) as price_sum, count(*) as days, sum(orders) as orders
            from product_days f
            join stg_products p on p.product_id = f.product_id
            join stg_categories c on c.category_id = f.category_id
            join stg_suppliers s on s.supplier_id = f.supplier_id
            group by product_name, category_name, company_name
        )
        order by cents desc, product_name, category_name, supplier
        limit 15
    """,
    "mart_inventory_health": f"""
        select product_name, category_name, units_in_stock, units_on_order, reorder_level,
               {money("stock_cents")} as stock_value, is_low as is_below_reorder_level, supply::bigint as days_of_supply,
               {_bands("supply", 60, [30, 15], ["Overstocked", "Adequate Stock", "Low Stock", "Critical Stock"])}
               as stock_status,
               case when is_low then 'REORDER NEEDED' else 'Stock OK' end as action_required
        from inventory join stg_categories using (category_id)
    """,
    "mart_customer_ltv": _lifetime(50000, [20000, 10000]),
    "mart_customer_ltv_wide_tiers": _lifetime(1500000, [1200000, 800000]),
    "mart_customer_geography": f"""
        select country, region, count(distinct customer_id) as customer_count, {money("sum(cents)")} as total_revenue,
               sum(units)::bigint as total_units_sold, {ratio("sum(avg_cents)", "count(*)")} as avg_order_value,
               {ratio("sum(cents)", "count(distinct customer_id)")} as revenue_per_customer,
               grouping(country, region)::bigint as grouping_id
        from customer_days join stg_customers using (customer_id)
        group by grouping sets ((country), (country, region))
    """,
    "mart_sales_dashboard": f"""
        select yr as year, mo as month, category_name, first_name || ' ' || last_name as employee,
               h.company_name as shipper, count(distinct order_id) as order_count,
               sum(quantity)::bigint as total_units_sold, {money("sum(total_cents)")} as gross_sales,
               {money("sum(tax_cents)")} as total_tax, {money("sum(freight_share)")} as total_freight,
               {money("sum(total_cents + tax_cents + freight_share)")} as total_revenue,
               {ratio("sum(total_cents)", "count(*)")} as avg_order_value,
               {money(nearest("sum(discount_percent * price_cents * quantity)", "100"))} as total_discounts
        from mart_sales
        join stg_categories using (category_id)
        join stg_employees using (employee_id)
        join stg_shippers h on h.shipper_id = ship_via
        group by yr, mo, category_name, first_name || ' ' || last_name, h.company_name
    """,
    "mart_sales_trend": f"""
        select yr as year, mo as month, {money("cents")} as monthly_sales, {money("previous")} as previous_month_sales,
               {growth("cents", "previous")} as monthly_growth_percent,
               {ratio("window_sum", "window_size")} as three_month_moving_avg, {money("ytd")} as ytd_sales,
               case sign(cents * window_size - window_sum)
                    when 1 then 'Above Trend' when -1 then 'Below Trend' else 'On Trend' end as trend_status
        from (
            select *, lag(cents) over w as previous, sum(cents) over (partition by yr order by mo) as ytd,
                   sum(cents) over (w rows between 2 preceding and current row) as window_sum,
                   count(*) over (w rows between 2 preceding and current row) as window_size
            from (select yr, mo, sum(total_cents) as cents from mart_sales group by yr, mo)
            window w as (order by yr, mo)
        )
    """,
    "mart_employee_performance": _employees(100000, [50000, 25000]),
    "mart_employee_performance_wide_bands": _employees(13000000, [12000000, 11000000]),
    "mart_category_deep_dive": f"""
        select category_name, goods as product_count, units::bigint as total_units_sold, {money("cents")} as total_revenue,
               {ratio("cents", "units")} as avg_price_per_unit, (units // goods)::bigint as avg_units_per_product,
               {ratio("cents", "goods")} as avg_revenue_per_product, rank() over (order by cents desc) as revenue_rank,
               {ratio("cents * 10000", "(select sum(total_cents) from mart_sales)")} as market_share_percent
        from (select category_name, count(distinct product_id) as goods, sum(quantity) as units, sum(total_cents) as cents
              from mart_sales join stg_categories using (category_id) group by category_name)
    """,
    "mart_supplier_customer_links": _links(5),
    "mart_supplier_customer_links_two_orders": _links(2),
    "dq_record_counts": """
        select (select count(*) from customer) as staging_customers, (select count(*) from stg_customers) as dim_customers,
               (select count(*) from part) as staging_products, (select count(*) from dw_products) as dim_products,
               (select count(*) from orders) as staging_orders, (select count(*) from lineitem) as staging_order_details,
               (select count(*) from dw_sales) as fact_sales
    """,
    "dq_fact_integrity": """
        select count(*) as total_fact_records, count(*) - count(customer_id) as missing_customer_id,
               count(*) - count(product_id) as missing_product_id, count(*) - count(date_id) as missing_date_id,
               count(*) filter (total_cents < 0) as negative_total_amount,
               count(*) filter (quantity <= 0) as invalid_quantity
        from dw_sales
    """,
    "dq_orphans": """
        select (select count(*) from dw_sales where customer_id not in (select c_custkey from customer))
               as orphaned_customer_records,
               (select count(*) from dw_sales where product_id not in (select product_id from dw_products))
               as orphaned_product_records,
               (select count(*) from dw_sales where date_id not in (select date_id from dw_days))
               as orphaned_date_records
    """,
    "dq_business_ranges": f"""
        select {money("min(price_cents)")} as min_unit_price, {money("max(price_cents)")} as max_unit_price,
               {money("min(discount_percent)")} as min_discount, {money("max(discount_percent)")} as max_discount,
               {money("min(total_cents)")} as min_total_amount, {money("max(total_cents)")} as max_total_amount,
               count(*) as total_records_validated
        from dw_sales
    """,
    "dq_amount_ranges": f"""
        select {money("min(total_cents)")} as min_total_amount, {money("max(total_cents)")} as max_total_amount,
               {ratio("sum(total_cents)", "count(*)")} as avg_total_amount, {money("min(tax_cents)")} as min_tax_amount,
               {money("max(tax_cents)")} as max_tax_amount, count(*) as total_records_validated
        from dw_sales where total_cents >= 0 and tax_cents >= 0
    """,
    "dq_completeness": f"""
        select table_name, column_name, n as total_rows, nulls as null_count, {ratio("nulls * 10000", "n")} as null_percentage
        from (
        {" union all ".join(
            f"select '{table}' as table_name, '{column}' as column_name, count(*) as n, "
            f"count(*) filter ({column} is null) as nulls from {source}"
            for table, source, columns in [
                ("dim_customer", "stg_customers", ["customer_id", "company_name", "region", "postal_code", "phone"]),
                ("dim_product", "dw_products", ["product_name"]),
                ("dim_employee", "stg_employees", ["title"]),
                ("fact_sales", "dw_sales", ["customer_id", "product_id"]),
                ("staging_suppliers", "stg_suppliers", ["homepage"]),
            ]
            for column in columns
        )}
        )
    """,
    "dq_temporal": f"""
        select yr as year, mo as month, count(*) as sales_count, {money("sum(total_cents)")} as total_sales,
               {ratio("sum(total_cents)", "count(*)")} as avg_sale_amount
        from dw_sales group by yr, mo
    """,
    "dw_kpis": f"""
        select count(distinct customer_id) as total_customers, count(distinct product_id) as total_products,
               count(distinct employee_id) as total_employees, count(*) as total_transactions,
               {money("sum(total_cents)")} as total_sales_revenue, {money("sum(tax_cents)")} as total_tax_collected,
               {ratio("sum(total_cents)", "count(*)")} as avg_transaction_value, min(d)::varchar as first_sale_date,
               max(d)::varchar as last_sale_date,
               {ratio("sum(total_cents)", "count(distinct customer_id)")} as avg_revenue_per_customer
        from dw_sales
    """,
    "dw_monthly_summary": f"""
        select yr as year, mo as month, month_name, count(*) as monthly_transactions,
               {money("sum(total_cents)")} as monthly_sales, {money("sum(tax_cents)")} as monthly_tax,
               count(distinct customer_id) as active_customers, count(distinct product_id) as products_sold
        from dw_sales group by yr, mo, month_name
    """,
    "dq_score": _score("parts", "total_cents * 100"),
    "dq_score_corrected": _score("(parts + 50) // 100", "total_cents"),
}
REPORTS["dw_stored_weekly_category_sales"] = REPORTS["dw_weekly_category_sales"]
REPORTS["dw_stored_fact_keys"] = """
    select load_run, n_rows, n_rows as n_keys, before + 1 as lowest_key, before + n_rows as highest_key
    from (select load_run, n_rows, (coalesce(sum(n_rows) over (order by load_run rows between unbounded preceding
                                                               and 1 preceding), 0))::bigint as before
          from (select case when d <= date '1996-12-31' then '1-early' else '2-late' end as load_run, count(*) as n_rows
                from dw_sales group by all))
"""
