"""DuckDB common table expressions for every layer, used by the correctness queries."""

from __future__ import annotations

import re

from checks.raw_entities import RAW_SQL, duckdb_sql

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
STATUSES = "('created', 'paid', 'shipped', 'cancelled', 'refunded')"


def token(name: str) -> str:
    return rf"lower(regexp_replace(trim({name}), '[\s\-]+', '_', 'g'))"


CTES: dict[str, str] = {f"raw_{name}": duckdb_sql(name) for name in RAW_SQL}

# m_*: refined rows with defect and keep markers; s_*: silver.
CTES |= {
    "m_customers": f"""
        select *, customer_id <> '' as keep, customer_id = '' or not is_email_valid as defect
        from (select coalesce(trim(customer_id), '') as customer_id, customer_name,
                     lower(nullif(trim(email), '')) as email, city, state, country, created_at,
                     coalesce(regexp_matches(lower(trim(email)), '{EMAIL}'), false)
                         as is_email_valid
              from raw_customers)""",
    "m_products": f"""
        select nullif(trim(product_id), '') as product_id, product_name,
               coalesce(nullif({token("category")}, ''), 'unknown') as category,
               greatest(coalesce(unit_price, 0), 0) as unit_price,
               nullif(trim(product_id), '') is not null as keep,
               nullif(trim(product_id), '') is null or unit_price is null or unit_price < 0
                   as defect
        from raw_products""",
    "m_campaigns": """
        select campaign_id, campaign_name, channel, try_cast(start_date as date) as start_date,
               try_cast(end_date as date) as end_date,
               greatest(coalesce(budget, 0), 0) as budget, true as keep,
               budget is null or budget < 0 or try_cast(start_date as date) is null
                   or try_cast(end_date as date) is null as defect
        from raw_campaigns""",
    "m_orders": f"""
        select order_id, customer_id, order_date, payment_method,
               case when is_valid_status then status end as order_status, is_valid_status,
               true as keep, not is_valid_status or order_date is null as defect
        from (select order_id, customer_id, try_cast(order_date as timestamp) as order_date,
                     payment_method, status, status in {STATUSES} as is_valid_status
              from (select *, {token("order_status")} as status from raw_orders))""",
    "m_order_items": """
        select *, gross_amount - cast(discount_amount as decimal(18, 2)) as net_amount,
               quantity > 0 as is_quantity_valid, true as keep, not quantity > 0 as defect
        from (select order_item_id, order_id, product_id, coalesce(quantity, 0) as quantity,
                     coalesce(unit_price, 0) as unit_price,
                     coalesce(discount_amount, 0) as discount_amount,
                     cast(coalesce(quantity, 0) * cast(coalesce(unit_price, 0) as decimal(24, 6))
                          as decimal(18, 2)) as gross_amount
              from raw_order_items)""",
    "m_web_events": f"""
        select event_id, customer_id, session_id, nullif({token("event_type")}, '') as event_type,
               page, event_timestamp, device, campaign_id, true as keep,
               nullif({token("event_type")}, '') is null or event_timestamp is null as defect
        from raw_web_events""",
}
CTES |= {f"s_{name}": f"select * exclude (keep, defect) from m_{name} where keep" for name in
         RAW_SQL}

# g_*: gold with natural ids in place of surrogate keys.
CTES |= {
    "g_dim_customer": """
        select customer_id, customer_name, email, city, state, country,
               try_cast(created_at as timestamp) as created_at
        from s_customers where trim(customer_id) <> ''
        qualify row_number() over (partition by customer_id order by customer_name, email, city,
            state, country, created_at, is_email_valid) = 1""",
    "g_dim_product": """
        select product_id, product_name, category, cast(unit_price as decimal(18, 2)) as unit_price
        from s_products where trim(product_id) <> ''
        qualify row_number() over (partition by product_id order by product_name, category,
            unit_price) = 1""",
    "g_dim_campaign": """
        select campaign_id, campaign_name, channel, start_date, end_date,
               cast(budget as decimal(18, 2)) as budget
        from s_campaigns where trim(campaign_id) <> ''
        qualify row_number() over (partition by campaign_id order by campaign_name, channel,
            start_date, end_date, budget) = 1""",
    "g_dim_date": """
        select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date,
               cast(year(full_date) as int) as year, cast(quarter(full_date) as int) as quarter,
               cast(month(full_date) as int) as month, monthname(full_date) as month_name,
               cast(day(full_date) as int) as day,
               cast(dayofweek(full_date) + 1 as int) as day_of_week
        from (select cast(order_date as date) as full_date from s_orders
              union select cast(event_timestamp as date) from s_web_events)
        where full_date is not null""",
    "g_touch": """
        select customer_id, cast(event_timestamp as date) as sales_date, campaign_id
        from s_web_events
        where campaign_id is not null and customer_id is not null and event_timestamp is not null
        qualify row_number() over (partition by customer_id, cast(event_timestamp as date)
            order by event_timestamp desc, event_id desc) = 1""",
    "g_sales": """
        select i.order_item_id, i.order_id, o.customer_id, i.product_id, g.campaign_id,
               d.date_key, d.full_date, i.quantity, i.gross_amount,
               cast(i.discount_amount as decimal(18, 2)) as discount_amount, i.net_amount,
               o.payment_method, o.order_status
        from s_order_items i join s_orders o on i.order_id = o.order_id
             join g_dim_customer c on o.customer_id = c.customer_id
             join g_dim_product p on i.product_id = p.product_id
             join g_dim_date d on cast(o.order_date as date) = d.full_date
             left join g_touch t on t.customer_id = o.customer_id
                 and t.sales_date = cast(o.order_date as date)
             left join g_dim_campaign g on g.campaign_id = t.campaign_id
        where i.is_quantity_valid and o.is_valid_status and o.order_date is not null""",
    "g_events": """
        select e.event_id, e.customer_id, g.campaign_id, d.date_key, e.event_type, e.page,
               e.device, e.session_id
        from s_web_events e join g_dim_customer c on e.customer_id = c.customer_id
             join g_dim_date d on cast(e.event_timestamp as date) = d.full_date
             left join g_dim_campaign g on g.campaign_id = e.campaign_id
        where e.event_type is not null and e.event_timestamp is not null""",
}

# Run history and file listing derived from the same tables.
CTES |= {
    "run_inputs": """
        select 'load_' || payment_method as job_name,
               cast(cast(order_date as date) as timestamp) as started_at,
               cast(cast(order_date as date) as timestamp) + to_seconds(count(*)) as finished_at,
               cast(count(*) as double) as duration_seconds,
               count(*) as records_in, count_if(not defect or defect is null) as records_out,
               count_if(defect) as invalid_records,
               case when day(cast(order_date as date)) % 7 = 0 then 'success' end
                   as explicit_status,
               case when count_if(defect) * 25 > count(*) then 'too many defects' end
                   as error_message
        from m_orders group by payment_method, cast(order_date as date)""",
    "runs": """
        select *, case when explicit_status is not null then explicit_status
                       when length(error_message) > 0 then 'failed'
                       when invalid_records > 0 then 'warning' else 'success' end as status
        from run_inputs""",
    "listing": "select lang as layer, 'doc-' || doc_id as path, n_chars as length from documents",
    "profile": """
        select *, file_count >= 5
                  and coalesce(small_file_count / nullif(file_count, 0) >= 0.5
                               or average_file_size_bytes < 2500, false)
                  as has_small_files_problem
        from (select l.layer, coalesce(file_count, 0) as file_count,
                     cast(coalesce(total, 0) as bigint) as total_size_bytes,
                     coalesce(small, 0) as small_file_count,
                     cast(coalesce(total // nullif(file_count, 0), 0) as bigint)
                         as average_file_size_bytes,
                     coalesce(round(small / nullif(file_count, 0), 4), 0.0) as small_file_ratio
              from (values ('de'), ('en'), ('es'), ('fr'), ('none')) l(layer)
              left join (select layer, count(*) as file_count, sum(length) as total,
                                count_if(length < 2500) as small from listing group by layer) f
                  on f.layer = l.layer)""",
    "estimates": """
        select *, round(greatest(scan_cost - optimized_scan_cost, 0), 6) as savings_cost,
               greatest(total_size_bytes - optimized_scan_bytes, 0) as savings_bytes
        from (select *, total_size_bytes as scan_bytes,
                     round(total_size_bytes / 1073741824.0 * 1000.0, 6) as storage_cost,
                     round(total_size_bytes / 1099511627776.0 * 900000.0, 6) as scan_cost,
                     round(optimized_scan_bytes / 1099511627776.0 * 900000.0, 6)
                         as optimized_scan_cost
              from (select *, cast(trunc(total_size_bytes::double * 0.35::double * 0.25::double)
                        as bigint) as optimized_scan_bytes from profile))""",
}


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in ordered)
    return f"with {parts}\n{body.strip()}"
