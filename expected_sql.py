"""SQL that DuckDB runs on the test tables to check the queries of ``__spark_entry__``.

Each query is a body after the named steps it builds on; ``_STEPS`` holds the steps in order of
dependence. Money is computed as decimals and returned as doubles, as the queries do. Tiers, scores
and the like are written in another form than in the library on purpose, to test one by the other.
"""

from __future__ import annotations

import re

AS_OF = "2001-08-02"
FIRST_LOAD_BEFORE = "2001-01-01"
LAST_MONTH = "2001-07-01"
DASHBOARD_SINCE = "2001-02-01"
LOOKUP_CUSTOMER = "8"

_DELIMITERS = r"""-!?@"^#$&~_,.:;+*%/|\\\[\](){}<>\s"""


def _title(x: str) -> str:
    words = f"regexp_extract_all(lower(trim({x})), '[^{_DELIMITERS}]*[{_DELIMITERS}]?')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def _month(x: str) -> str:
    return f"cast(date_trunc('month', {x}) as date)"


def _dbl(x: str) -> str:
    return f"cast({x} as double)"


def _total(x: str, where: str = "true") -> str:
    return f"{_dbl(f'sum({x}) filter ({where})')}"


def _rate(part: str, whole: str, digits: int = 2) -> str:
    return f"round({_dbl(part)} / nullif({_dbl(whole)}, 0) * 100, {digits})"


def _band(x: str, sign: str, bounds: tuple[int, ...]) -> str:
    met = " + ".join(f"cast({x} {sign} {b} as int)" for b in bounds)
    return f"cast(1 + {met} as int)"


_SEGMENT = """case when c_custkey % 59 <> 0 then case c_mktsegment when 'AUTOMOBILE' then 'VIP'
    when 'BUILDING' then 'regular' when 'FURNITURE' then ' new' when 'HOUSEHOLD' then 'at-risk'
    else 'churned' end end"""
_DIMENSIONS = """p.product_name, p.category, p.sub_category, cast(p.unit_price as double) unit_price,
    cast(p.cost_price as double) cost_price, p.gross_margin_pct, p.price_tier"""

_STEPS = {
    "line_totals": """
        select l_orderkey, min(l_partkey) first_part, count(*) n_lines
        from lineitem group by l_orderkey""",
    "first_days": """
        select o_custkey, cast(min(o_orderdate) as date) first_day from orders group by o_custkey""",
    "orders_in": """
        select case when o_orderkey % 97 <> 0 then cast(o_orderkey as varchar) end order_id,
          case when o_orderkey % 101 <> 0 then cast(o_custkey as varchar) end customer_id,
          o_orderdate order_date, o_orderkey, cast(first_part as varchar) product_id,
          case when o_orderkey % 89 = 0 then null when o_orderstatus = 'F' then ' Completed' when o_orderstatus = 'O' then 'PENDING'
               when o_orderkey % 2 = 0 then 'returned ' else 'Cancelled' end raw_status,
          cast(case when o_orderkey % 83 = 0 then 0 when o_orderkey % 73 = 0 then -1 else 1 end
            * case when o_orderkey % 7 = 0
              then round(cast(o_totalprice as decimal(18,2)) * cast(0.001 as decimal(4,3)), 4)
              else round(cast(o_totalprice as decimal(18,2)) * cast(0.001 as decimal(4,3)), 2) end
            as decimal(18,4)) amount,
          cast(case when o_orderkey % 79 = 0 then -1 - o_orderkey % 5 else o_orderkey % 5 end
               as decimal(18,2)) discount,
          cast(cast(o_orderkey % 3 as decimal(9,2)) * cast(2.5 as decimal(3,2))
               as decimal(18,2)) shipping,
          cast(coalesce(n_lines, 1) as int) quantity
        from orders left join line_totals on l_orderkey = o_orderkey""",
    "o": f"""
        select order_id, customer_id, product_id, order_date, {_month('order_date')} order_month,
          cast(date_trunc('week', order_date) as date) order_week,
          cast(dayofweek(order_date) as int) order_day_of_week,
          trim(lower(raw_status)) status,
          coalesce(trim(lower(raw_status)) = 'completed', false) is_completed,
          cast(round(amount, 2) as decimal(18,2)) gross, discount, shipping,
          cast(round(amount - discount, 2) as decimal(18,2)) net,
          cast(round(amount - discount + shipping, 2) as decimal(18,2)) total, quantity
        from orders_in
        where amount > 0 and order_id is not null and customer_id is not null""",
    "paid": "select * from o where status = 'completed'",
    "c": f"""
        select cast(c_custkey as varchar) customer_id, {_title("' customer'")} first_name,
          {_title('substr(c_name, 10)')} last_name,
          lower(trim(concat(' ', upper(c_name), '@Example.COM'))) email,
          {_title('n_name')} country, first_day signup_date,
          cast(date_diff('day', first_day, date '{AS_OF}') as int) days_since_signup,
          cast(date_diff('month', first_day, date '{AS_OF}') as int) months_since_signup,
          {_title(_SEGMENT)} customer_segment
        from customer join nation on n_nationkey = c_nationkey
          left join first_days on o_custkey = c_custkey
        where c_custkey % 97 <> 0 and c_custkey % 53 <> 0""",
    "prices": """
        select *, cast((cast(p_retailprice as decimal(9,2)) - 895) * 2 as decimal(18,2))
            * case when p_partkey % 61 = 0 then 0 when p_partkey % 67 = 0 then -1 else 1 end price,
          cast(round((cast(p_retailprice as decimal(9,2)) - 895) * 2 * (50 + p_size)
               * cast(0.008 as decimal(4,3)), 2) as decimal(18,2)) cost
        from part""",
    "p": f"""
        select cast(p_partkey as varchar) product_id, trim(concat('  ', p_name)) product_name,
          {_title('p_type')} category, {_title('p_brand')} sub_category, price unit_price,
          cost cost_price, {_rate('price - cost', 'price')} gross_margin_pct,
          case when price >= 150 then 'Luxury' when price >= 75 then 'Premium'
               when price >= 25 then 'Mid-Range' else 'Budget' end price_tier
        from prices where price > 0 and p_partkey % 71 <> 0""",
    "s": """
        select *, case channel when 'organic_search' then 'Organic' when 'direct' then 'Organic'
            when 'paid_search' then 'Paid' when 'social' then 'Paid' when 'email' then 'Owned'
            else 'Referral' end channel_group,
          round(time_on_site / 60, 1) time_on_site_mins,
          pages_visited = 1 and time_on_site < 10 is_bounce
        from (
          select cast(event_id as varchar) session_id,
            case when event_id % 103 <> 0 then cast(user_id as varchar) end customer_id,
            cast(ts as date) session_date,
            case when event_id % 73 <> 0 then
              ['organic_search', 'direct', 'paid_search', 'social', 'email', 'referral']
                [(user_id + event_id % (1 + user_id % 3)) % 6 + 1] end channel,
            cast(floor("value") as int) % 5 + 1 pages_visited,
            cast(floor("value" * 3) as int) time_on_site, event_type = 'purchase' converted
          from events where event_id % 97 <> 0)""",
    "per_buyer": f"""
        select customer_id, count(*) total_orders, sum(gross) gross, sum(net) net,
          sum(discount) discounts, cast(sum(net) as double) / count(net) avg_order_value,
          min(order_date) first_order_date, max(order_date) last_order_date,
          cast(date_diff('day', cast(max(order_date) as date), date '{AS_OF}') as int) idle,
          cast(date_diff('day', cast(min(order_date) as date), cast(max(order_date) as date))
               as int) lifespan,
          count(distinct order_month) active_months
        from paid group by customer_id""",
    "per_visitor": f"""
        select customer_id, count(*) total_sessions, count(*) filter (converted) converting_sessions,
          avg(time_on_site) avg_time_on_site_secs, avg(pages_visited) avg_pages_per_session,
          {_rate('count(*) filter (converted)', 'count(*)')} session_conversion_rate
        from s group by customer_id""",
    "c360": f"""
        select customer_id, full_name, email, country, signup_date, days_since_signup,
          customer_segment, total_orders, net, avg_order_value,
          {_dbl('gross')} total_gross_revenue, {_dbl('net')} total_net_revenue,
          {_dbl('discounts')} total_discounts, first_order_date, last_order_date,
          idle days_since_last_order, lifespan customer_lifespan_days, active_months,
          total_sessions, avg_time_on_site_secs, avg_pages_per_session, session_conversion_rate,
          round({_dbl('net')} / nullif(days_since_signup, 0) * 365, 2) annualized_revenue,
          {_band('idle', '<=', (30, 60, 90, 180))} recency_score,
          {_band('total_orders', '>=', (2, 5, 10, 20))} frequency_score,
          {_band('net', '>=', (200, 500, 1000, 2000))} monetary_score,
          case when idle <= 90 then 'Low Risk' when idle <= 180 then 'Medium Risk'
               else 'High Risk' end churn_risk
        from (
          select c.*, first_name || ' ' || last_name full_name,
            first_order_date, last_order_date,
            coalesce(b.total_orders, 0) total_orders, coalesce(gross, 0) gross,
            coalesce(net, 0) net, coalesce(discounts, 0) discounts,
            coalesce(b.avg_order_value, 0) avg_order_value, coalesce(idle, 9999) idle,
            coalesce(lifespan, 0) lifespan, coalesce(active_months, 0) active_months,
            coalesce(total_sessions, 0) total_sessions,
            coalesce(avg_time_on_site_secs, 0) avg_time_on_site_secs,
            coalesce(avg_pages_per_session, 0) avg_pages_per_session,
            coalesce(session_conversion_rate, 0) session_conversion_rate
          from c left join per_buyer b using (customer_id)
            left join per_visitor using (customer_id))""",
    "e": f"""
        select o.*, {_DIMENSIONS}, cast(o.net - cost_price * quantity as decimal(18,2)) profit,
          {_rate('o.net - cost_price * quantity', 'o.net')} margin,
          v.country, v.customer_segment, v.churn_risk
        from o left join p using (product_id) left join c360 v using (customer_id)""",
    "touches": """
        select customer_id, channel first_touch_channel, channel_group first_touch_channel_group,
          min(session_date) first_session_date
        from s group by all""",
    "first_touches": """
        select customer_id, channel first_touch_channel, channel_group first_touch_channel_group
        from (select *, row_number() over (partition by customer_id
                                           order by session_date, session_id) nth from s)
        where nth = 1 and customer_id is not null""",
    "cohorts": f"""
        select customer_id, cast({_month('min(order_date)')} as timestamp) cohort_month
        from paid group by customer_id""",
    "sizes": """
        select cohort_month, count(distinct customer_id) cohort_size from cohorts
        group by cohort_month""",
}

_SUMMARY = f"""count(*) total_orders, count(*) filter (is_completed) completed_orders,
    {_total('gross', 'is_completed')} gross_revenue, {_total('net', 'is_completed')} net_revenue,
    {_total('discount', 'is_completed')} total_discounts,
    {_total('shipping', 'is_completed')} shipping_revenue,
    {_total('profit', 'is_completed')} total_profit,
    cast(sum(quantity) filter (is_completed) as bigint) units_sold,
    {_total('net', 'is_completed')} / count(net) filter (is_completed) avg_order_value,
    {_rate('sum(profit) filter (is_completed)', 'sum(net) filter (is_completed)')}
      profit_margin_pct"""
_DAILY = """cast(order_date as date) revenue_date, order_month, order_week, category, sub_category,
    price_tier, country, customer_segment"""
_MONEY = """cast(gross as double) gross_amount, cast(discount as double) discount_amount,
    cast(shipping as double) shipping_cost, cast(net as double) net_amount,
    cast(total as double) total_amount"""
_STAGED = f"""order_id, customer_id, product_id, order_date, order_month, order_week,
    order_day_of_week, status, is_completed, {_MONEY}, quantity"""
_PRODUCT = """product_name, category, sub_category, unit_price, cost_price, gross_margin_pct,
    price_tier, cast(profit as double) order_profit"""
_LOADED = f"""select order_id, customer_id, order_date, order_month, order_week, status,
    is_completed, {_MONEY}, quantity, {_PRODUCT}, margin order_profit_margin_pct, country,
    customer_segment from e"""


def _credit(touches: str) -> str:
    return f"""
        select first_touch_channel, first_touch_channel_group,
          count(distinct customer_id) acquired_customers,
          {_total('net')} / nullif(count(net), 0) avg_customer_ltv,
          avg(total_orders) avg_orders_per_customer,
          cast(cast(sum(cast(cast(avg_order_value as varchar) as decimal(38,18))) as varchar)
            as double) / nullif(count(avg_order_value), 0) avg_order_value,
          {_total('net')} total_attributed_revenue
        from {touches} left join c360 using (customer_id) group by all"""


def _values(check: str, table: str, column: str, where: str) -> str:
    return f"""
        select '{table}' model, '{column}' column_name, '{check}' test,
          cast({column} as varchar) "value", count(*) "rows"
        from ({where}) group by {column}"""


def _repeated(table: str, column: str, rows: str) -> str:
    where = f"select * from ({rows}) where {column} is not null"
    return _values("unique", table, column, where) + " having count(*) > 1"


_IDS = {
    "stg_orders": "order_id", "stg_customers": "customer_id", "stg_products": "product_id",
    "mart_customer_360": "customer_id",
    "mart_revenue": """revenue_date, order_month, order_week, category, sub_category, price_tier,
        country, customer_segment""",
    "mart_channel_attribution": "first_touch_channel, first_touch_channel_group",
}


def _row_text(columns: str) -> str:
    written = [
        rf"coalesce(replace(replace(cast({c.strip()} as varchar), '\', '\\'), '|', '\|'), '\N')"
        for c in columns.split(",")
    ]
    return " || '|' || ".join(written)


def _missing(table: str, column: str, rows: str) -> str:
    return f"""
        select '{table}' model, '{column}' column_name, 'not_null' test,
          {_row_text(_IDS[table])} row_key from ({rows}) where {column} is null"""


def _outside(table: str, column: str, rows: str, accepted: str) -> str:
    where = f"select * from ({rows}) where {column} not in ({accepted})"
    return _values("accepted_values", table, column, where)


_STATUSES = "'completed', 'returned', 'cancelled', 'pending'"
_SEGMENTS = "'Vip', 'Regular', 'New', 'At-Risk', 'Churned'"
_RISKS = "'High Risk', 'Medium Risk', 'Low Risk'"
_CHANNELS = _credit("touches")
_REVENUE = f"select {_DAILY}, {_SUMMARY} from e group by all"
_LINES = "select concat(l_orderkey, '-', l_linenumber) line_key from lineitem"
_RAW_SEGMENTS = f"select {_SEGMENT} segment from customer"
_UNIQUE = [
    ("stg_orders", "order_id", "from o"),
    ("stg_customers", "customer_id", "from c"),
    ("stg_customers", "email", "from c"),
    ("stg_products", "product_id", "from p"),
    ("mart_customer_360", "customer_id", "from c360"),
    ("mart_channel_attribution", "first_touch_channel", _CHANNELS),
    ("stg_sessions", "session_id", "from s"),
    ("mart_orders_incremental", "order_id", "from e"),
]
_NOT_NULL = [
    ("stg_orders", "order_id", "from o"),
    ("stg_orders", "customer_id", "from o"),
    ("stg_orders", "gross_amount", f"select {_STAGED} from o"),
    ("stg_orders", "net_amount", f"select {_STAGED} from o"),
    ("stg_customers", "customer_id", "from c"),
    ("stg_customers", "email", "from c"),
    ("stg_products", "product_id", "from p"),
    ("mart_customer_360", "customer_id", "from c360"),
    ("mart_customer_360", "recency_score", "from c360"),
    ("mart_revenue", "revenue_date", _REVENUE),
    ("mart_revenue", "gross_revenue", _REVENUE),
    ("mart_channel_attribution", "first_touch_channel", _CHANNELS),
    ("stg_sessions", "session_id", "from s"),
    ("mart_orders_incremental", "order_id", "from e"),
]
_ACCEPTED = [
    ("stg_orders", "status", "from o", _STATUSES),
    ("stg_customers", "customer_segment", "from c", _SEGMENTS),
    ("mart_customer_360", "churn_risk", "from c360", _RISKS),
]
_ORPHANS = "select customer_id from o where customer_id not in (select customer_id from c)"


def _report() -> str:
    def line(table: str, column: str, test: str, rows: str) -> str:
        return f"""select '{table}' model, '{column}' column_name, '{test}' test,
            (select count(*) from ({rows})) failures"""

    lines = [line(t, c, "unique", _repeated(t, c, rows)) for t, c, rows in _UNIQUE]
    lines += [
        line(t, c, "not_null", f"select * from ({rows}) where {c} is null")
        for t, c, rows in _NOT_NULL
    ]
    lines += [
        line(t, c, "accepted_values", f"select * from ({rows}) where {c} not in ({values})")
        for t, c, rows, values in _ACCEPTED
    ]
    lines.append(line("stg_orders", "customer_id", "relationships",
                      f"select distinct customer_id from ({_ORPHANS})"))
    lines.append(line("stg_orders", "net_amount", "net_le_gross", "from o where net > gross"))
    return " union all ".join(lines)


_QUERIES = {
    "stg_orders": f"select {_STAGED} from o",
    "stg_customers": """select customer_id, first_name, last_name,
        first_name || ' ' || last_name full_name, email, country, signup_date, days_since_signup,
        months_since_signup, customer_segment from c""",
    "stg_products": """select product_id, product_name, category, sub_category,
        cast(unit_price as double) unit_price, cast(cost_price as double) cost_price,
        cast(unit_price - cost_price as double) gross_margin_amount, gross_margin_pct, price_tier
        from p""",
    "stg_sessions": """select session_id, customer_id, session_date, channel, channel_group,
        pages_visited, time_on_site, time_on_site_mins, is_bounce, converted from s""",
    "customer_orders": """select customer_id, total_orders,
        cast(gross as double) total_gross_revenue, cast(net as double) total_net_revenue,
        cast(discounts as double) total_discounts, avg_order_value, first_order_date,
        last_order_date, idle days_since_last_order, lifespan customer_lifespan_days,
        active_months from per_buyer""",
    "customer_sessions": "select * from per_visitor",
    "mart_customer_360": "select * exclude (net) from c360",
    "customer_lookup": f"""select * exclude (net) from c360
        where customer_id = '{LOOKUP_CUSTOMER}' and customer_segment = 'Vip'""",
    "order_enriched": f"""select order_id, order_date, order_month, order_week, order_day_of_week,
        status, is_completed, {_MONEY}, quantity, {_PRODUCT}, country, customer_segment, churn_risk
        from e""",
    "mart_revenue": _REVENUE,
    "revenue_monthly": f"select order_month, category, {_SUMMARY} from e group by all",
    "dashboard_month_category": f"""
        select order_month, category, {_total('net', 'is_completed')} net_revenue from e
        where order_month >= date '{DASHBOARD_SINCE}' group by all""",
    "channel_daily": f"""
        select session_date, channel, channel_group, count(*) total_sessions,
          count(distinct customer_id) unique_visitors, count(*) filter (converted) conversions,
          count(*) filter (is_bounce) bounces,
          {_dbl('sum(cast(time_on_site_mins * 10 as bigint))')} / (count(time_on_site_mins) * 10)
            avg_time_on_site_mins,
          avg(pages_visited) avg_pages_per_session,
          {_rate('count(*) filter (converted)', 'count(*)')} conversion_rate_pct,
          {_rate('count(*) filter (is_bounce)', 'count(*)')} bounce_rate_pct
        from s group by session_date, channel, channel_group""",
    "channel_touches": "from touches",
    "channel_attribution_any_touch": _CHANNELS,
    "channel_attribution_first_touch": _credit("first_touches"),
    "orders_incremental_full": _LOADED,
    "orders_incremental_batch": f"""select {_STAGED} from o where order_date > (
        select max(order_date) from o where order_date < timestamp '{FIRST_LOAD_BEFORE}')""",
    "orders_incremental_merged": _LOADED,
    "customer_cohorts": "from cohorts",
    "cohort_sizes": "from sizes",
    "cohort_retention": """
        select cohort_month, cast(date_diff('month', cohort_month, order_date) as int)
            months_since_cohort, count(distinct customer_id) active_customers, cohort_size,
          round(count(distinct customer_id) * 100 / cohort_size, 1) retention_rate
        from paid join cohorts using (customer_id) join sizes using (cohort_month)
        group by 1, 2, cohort_size order by 1, 2""",
    "date_spine": """
        select d date_day, cast(extract(year from d) as int) "year",
          cast(extract(month from d) as int) "month", cast(extract(day from d) as int) "day",
          cast(extract(quarter from d) as int) "quarter", cast(dayofweek(d) as int) day_of_week,
          strftime(d, '%a') day_name, strftime(d, '%b') month_name,
          cast(date_trunc('week', d) as date) week_start_date,
          cast(date_trunc('month', d) as date) month_start_date,
          cast(date_trunc('quarter', d) as date) quarter_start_date,
          isodow(d) > 5 is_weekend
        from (select cast(unnest(generate_series(min(order_date), max(order_date),
                                                 interval 1 day)) as date) d from o)""",
    "safe_divide": f"""select order_id,
        {_dbl('net')} / nullif({_dbl('shipping')}, 0) net_per_shipping from o""",
    "cents_to_dollars": """select o_orderkey,
        cast(cast(o_totalprice as decimal(18,2)) as double) dollars from orders""",
    "dq_unique": " union all ".join(
        [_repeated(*u) for u in _UNIQUE[:6]] + [_repeated("lineitem", "line_key", _LINES)]
    ),
    "dq_not_null": " union all ".join(_missing(*check) for check in _NOT_NULL[:12]),
    "orders_schema_evolution": """
        select order_id, customer_id, order_date, order_month,
          case when order_month = date '2001-01-01' then status || ', seen again'
            else status end status,
          cast(net as double) net_amount,
          case when order_date >= timestamp '2001-01-01'
            then case when quantity > 3 then 'large' else 'small' end end basket
        from o""",
    "orders_moved": _LOADED,
    "orders_interleaved": f"""
        select 'order_date' lookup, order_id, cast(net as double) net_amount from o
        where order_date >= timestamp '{FIRST_LOAD_BEFORE}'
        union all select 'customer_id', order_id, cast(net as double) from o
        where customer_id = '{LOOKUP_CUSTOMER}'
        union all select 'net_amount', order_id, cast(net as double) from o where net > 400""",
    "staging_view": f"""select {_STAGED}, timestamp '{FIRST_LOAD_BEFORE}' dbt_updated_at
        from o where is_completed""",
    "customer_360_stored": """select * exclude (net) from c360
        where customer_segment in ('Vip', 'New') and churn_risk = 'High Risk'""",
    "csv_quarantine": """
        select cast(p_partkey as varchar) product_id,
          case when p_partkey % 50 <> 0 and p_partkey % 61 <> 0 then 25.5::double end unit_price,
          case when p_partkey % 50 = 0 then 'unit_price is not of type double'
            when p_partkey % 61 = 0 then 'wrong number of fields' end reason
        from part where p_partkey % 71 <> 0""",
    "raw_orders_compacted": """
        select order_id, customer_id, order_date, raw_status status, cast(amount as double) amount,
          cast(discount as double) discount, cast(shipping as double) shipping_cost, product_id,
          quantity from orders_in""",
    "mart_revenue_maintained": _REVENUE,
    "customer_360_from_state": "select * exclude (net) from c360",
    "channel_visitors": """
        select period, cast(date_trunc(period, session_date) as date) period_start, channel,
          channel_group, count(distinct customer_id) unique_visitors
        from s, (values ('day'), ('week'), ('month')) p(period) group by all""",
    "cohort_retention_from_bits": """
        select cohort_month, cast(date_diff('month', cohort_month, order_date) as int)
            months_since_cohort, count(distinct customer_id) active_customers, cohort_size,
          round(count(distinct customer_id) * 100 / cohort_size, 1) retention_rate
        from paid join cohorts using (customer_id) join sizes using (cohort_month)
        group by 1, 2, cohort_size""",
    "order_versions": f"""
        select * exclude (nth) from (
          select *, row_number() over (partition by order_id
                                       order by loaded_at desc nulls last, digest desc) nth
          from (
            select order_id, status, loaded_at,
              md5({_row_text('order_id, status, order_date')}) digest
            from (
              select order_id, raw_status status, order_date, order_date loaded_at
                from orders_in where o_orderkey % 4 <> 0
              union all select order_id, 'pending', order_date,
                  order_date + to_days(cast(o_orderkey % 3 - 1 as int))
                from orders_in
              union all select order_id, 'cancelled', order_date, null from orders_in)
            where order_id is not null))
        where nth = 1""",
    "dq_accepted_values": " union all ".join(
        [_outside(*a) for a in _ACCEPTED]
        + [
            _outside("raw_orders", "status", "select raw_status status from orders_in", _STATUSES),
            _outside("raw_customers", "segment", _RAW_SEGMENTS, _SEGMENTS),
        ]
    ),
    "dq_relationships": " union all ".join(
        [
            _values("relationships", "stg_orders", "customer_id", _ORPHANS),
            _values("relationships", "stg_products", "product_id", """select product_id from p
                where product_id not in (select product_id from o where product_id is not null)"""),
        ]
    ),
    "dq_net_le_gross": f"select {_STAGED} from o where net > gross",
    "dq_net_positive": f"select {_STAGED} from o where net <= 0",
    "dq_report": _report(),
}


def _needed(sql: str, found: dict[str, str] | None = None) -> dict[str, str]:
    found = {} if found is None else found
    for name in set(re.findall(r"\b(?:from|join)\s+(\w+)", sql)) & _STEPS.keys() - found.keys():
        found[name] = _STEPS[name]
        _needed(_STEPS[name], found)
    return found


def _statement(body: str) -> str:
    needed = _needed(body)
    steps = [f"{name} as ({sql})" for name, sql in _STEPS.items() if name in needed]
    return (f"with {', '.join(steps)} " if steps else "") + body


def all_sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in _QUERIES.items()}
