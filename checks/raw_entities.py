"""The six raw entities derived from the test tables, as SQL both Spark and DuckDB accept.

Table names are written in braces: Spark binds DataFrames to them, DuckDB gets the plain names.
The tables nation and region have a fixed 25 and 5 rows.
"""

from __future__ import annotations

RAW_SQL = {
    "customers": """
        select case when c_custkey % 97 = 5 then ' '
                    else 'CUST-' || lpad(cast(c_custkey as string), 7, '0') end as customer_id,
               c_name as customer_name,
               case when c_custkey % 33 = 0 then cast(null as string)
                    when c_custkey % 33 = 1 then 'invalid-email'
                    else '  ' || replace(c_name, '#', '.') || '@Example.COM ' end as email,
               n_name as city, c_mktsegment as state, r_name as country,
               cast(date '2023-01-01' + cast(c_custkey % 365 as int) as string) as created_at
        from {customer} join {nation} on c_nationkey = n_nationkey
             join {region} on n_regionkey = r_regionkey""",
    "products": """
        select case when p_partkey % 101 = 7 then cast(null as string)
                    else 'PROD-' || lpad(cast(p_partkey as string), 7, '0') end as product_id,
               p_name as product_name,
               case when p_partkey % 41 = 0 then ' ' else ' ' || p_type || ' - Line ' end
                   as category,
               case when p_partkey % 37 = 0 then -p_retailprice else p_retailprice end
                   as unit_price
        from {part}""",
    "campaigns": """
        select 'CAMP-' || lpad(cast(n_nationkey as string), 5, '0') as campaign_id,
               n_name as campaign_name, lower(r_name) as channel,
               cast(date '2024-01-01' + n_nationkey as string) as start_date,
               case when n_nationkey % 11 = 10 then 'not-a-date'
                    else cast(date '2024-01-08' + n_nationkey as string) end as end_date,
               cast(n_nationkey * 500 - 1000 as double) as budget
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "orders": """
        select 'ORD-' || lpad(cast(o_orderkey as string), 8, '0') as order_id,
               'CUST-' || lpad(cast(o_custkey as string), 7, '0') as customer_id,
               cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as string) || ' 12:00:00'
                   as order_date,
               o_orderpriority as payment_method,
               case when o_orderkey % 33 = 0 then 'legacy_sync_error'
                    when o_orderkey % 33 = 1 then cast(null as string)
                    when o_orderstatus = 'F' then ' PAID '
                    when o_orderstatus = 'O' then 'Created' else 'shipped' end as order_status
        from {orders}""",
    "order_items": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-'
                   || cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-'
                   || cast(cast(l_shipdate as date) as string) as order_item_id,
               'ORD-' || lpad(cast(l_orderkey as string), 8, '0') as order_id,
               'PROD-' || lpad(cast(l_partkey as string), 7, '0') as product_id,
               cast(case when (l_orderkey + l_linenumber) % 33 = 0 then -l_quantity
                         else l_quantity end as int) as quantity,
               floor(l_extendedprice * 100 / l_quantity) / 100 as unit_price,
               case when (l_orderkey + l_linenumber) % 71 = 0 then floor(l_extendedprice) + 1
                    else floor(l_extendedprice * l_discount * 100) / 100 end as discount_amount
        from {lineitem}""",
    "web_events": """
        select 'EVT-' || lpad(cast(event_id as string), 8, '0') as event_id,
               'CUST-' || lpad(cast(user_id as string), 7, '0') as customer_id,
               'SESS-' || cast(user_id as string) || '-' || cast(cast(ts as date) as string)
                   as session_id,
               case when event_id % 53 = 0 then ' ' when event_type = 'view' then ' Page-View '
                    else upper(event_type) end as event_type,
               '/' || event_type as page, ts as event_timestamp,
               case event_id % 3 when 0 then 'mobile' when 1 then 'desktop' else 'tablet' end
                   as device,
               case when cast(regexp_extract(props, '[0-9]+', 0) as int) % 30 < 25
                    then 'CAMP-' || lpad(cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 30
                         as string), 5, '0')
                    else cast(null as string) end as campaign_id
        from {events}""",
}

TABLES = ("customer", "part", "orders", "lineitem", "events", "nation", "region")


def duckdb_sql(entity: str) -> str:
    return RAW_SQL[entity].format(**{name: name for name in TABLES})
