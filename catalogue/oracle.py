"""The catalogue's queries as DuckDB SQL over the same driver tables."""

from __future__ import annotations

import re


def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator rounded half away from zero, in exact integer arithmetic."""
    scale = 10**digits
    return (
        f"(sign({numerator}) * ((2 * {scale} * abs(cast({numerator} as hugeint)) + ({denominator}))"
        f" // (2 * ({denominator}))) / {scale}.0)"
    )


def _whole(*columns: str) -> str:
    """The clause that presents integer columns as 64-bit ones."""
    return f"replace ({', '.join(f'cast({c} as bigint) as {c}' for c in columns)})"


def _cents(amount: str) -> str:
    return f"cast(({amount}) * 100 as hugeint)"


# The nine feeds and, on top of them, the warehouse tables. A query gets the ones it names.
VIEWS = {
    "customers": """
        select cast(case when c_acctbal < -800 then -1 - c_custkey else c_custkey end as varchar) as customer_id,
               'u' || cast(c_custkey // 2 as varchar) as customer_unique_id,
               case when c_acctbal > 9500 then 'closed'
                    else c_nationkey || '-' || (c_custkey // 1000) end as zip,
               c_mktsegment as city, 'N' || c_nationkey as state
        from customer""",
    "geolocation": """
        select c_nationkey || '-' || (c_custkey // 1000) as zip, c_mktsegment as city, 'N' || c_nationkey as state,
               cast(c_acctbal as decimal(18,2)) as balance
        from customer""",
    "feed_orders": """
        select cast(o_orderkey as varchar) as order_id,
               case when o_totalprice >= 6000 then cast(o_custkey as varchar) end as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'canceled' end as order_status,
               case when o_totalprice < 490000 then o_orderdate + to_hours(cast(o_orderkey % 24 as int)) end as purchased,
               o_orderdate + to_days(cast(10 + o_orderkey % 15 as int)) as estimated,
               case when o_orderstatus = 'F' then o_orderdate + to_days(cast(4 + (o_orderkey * 7) % 25 as int))
                    + to_hours(case when o_orderkey % 3 = 0 then 10 else 0 end) end as delivered
        from orders""",
    "order_items": """
        select cast(case when l_quantity = 50 then -1 - l_orderkey else l_orderkey end as varchar) as order_id,
               l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m%d') as order_item_id,
               cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
               case when l_returnflag = 'R' and l_quantity = 1 then cast(0 as decimal(18,2))
                    else cast(l_extendedprice as decimal(18,2)) end as price,
               cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) * 15 as decimal(18,2)) as freight_value
        from lineitem""",
    "products": """
        select cast(case when p_size = 50 then -1 - p_partkey else p_partkey end as varchar) as product_id,
               case when p_brand <> 'Brand#25' then p_type end as category, p_size * 100 as weight_g, p_size as length_cm,
               case when p_size < 45 then p_size + 1 end as height_cm, p_size + 2 as width_cm
        from part""",
    "category_translation": """
        select distinct p_type as category, lower(p_type) || '_en' as english from part where p_type <> 'PROMO'""",
    "sellers": """
        select cast(case when s_acctbal < -400 then -1 - s_suppkey else s_suppkey end as varchar) as seller_id,
               s_nationkey, case when s_acctbal < 9000 then 'C' || s_nationkey end as seller_city,
               'N' || s_nationkey as seller_state
        from supplier""",
    "sellers_feed": """
        select seller_id, coalesce(seller_city, '') as seller_city,
               case when s_nationkey < 5 then 'ZZ' else seller_state end as seller_state
        from sellers
        union all
        select 'c' || c_custkey, c_mktsegment, 'N' || c_nationkey from customer where c_mktsegment = 'BUILDING'""",
    "order_payments": """
        select cast(event_id // 2 * 3 as varchar) as order_id, 1 + event_id % 2 as payment_sequential,
               event_type as payment_type, 1 + event_id % 12 as payment_installments,
               cast(value as decimal(18,2)) as payment_value
        from events""",
    "order_reviews": """
        select cast(event_id as varchar) as review_id,
               cast(case when event_type in ('click', 'view') then event_id // 2 * 3
                         else event_id * 3 // 2 end as varchar) as order_id,
               case when event_type <> 'error' then 1 + cast(floor(value) as bigint) % 5 end as review_score,
               date_trunc('day', ts) as created
        from events""",
    "holidays": """
        select * from (values (1, 1, 'New Year'), (4, 21, 'Tiradentes'), (5, 1, 'Labour Day'), (9, 7, 'Independence'),
            (10, 12, 'Our Lady Aparecida'), (11, 2, 'All Souls'), (11, 15, 'Republic Day'), (12, 25, 'Christmas')
        ) as h(hm, hd, yearly)""",
    "carnival": """
        select * from (values (date '2016-02-08'), (date '2016-02-09'), (date '2017-02-27'), (date '2017-02-28'),
            (date '2018-02-12'), (date '2018-02-13')) as c(carnival_day)""",
    "calendar_days": """
        select cast(d as date) as d from (
            select unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + interval 1 year - interval 1 day,
                                          interval 1 day)) as d
            from (select min(m) as lo, max(m) as hi from (
                select purchased as m from feed_orders union all select created from order_reviews)))""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as bigint) as date_sk, cast(d as varchar) as full_date, year(d) as year,
               quarter(d) as quarter, month(d) as month, monthname(d) as month_name, day(d) as day,
               dayname(d) as weekday_name,
               case when dayname(d) in ('Saturday', 'Sunday') then 1 else 0 end as is_weekend,
               case when carnival_day is not null or yearly is not null then 1 else 0 end as is_holiday,
               case when carnival_day is not null then 'Carnival' else yearly end as holiday_name
        from calendar_days left join carnival on d = carnival_day
             left join holidays on month(d) = hm and day(d) = hd
        union all
        select -1, '1900-01-01', 1900, 1, 1, 'Unknown', 1, 'Unknown', 0, 0, 'Unknown'""",
    "dim_order_status": """
        select row_number() over (order by order_status) as order_status_sk, order_status,
               case when order_status = 'delivered' then 1 else 0 end as is_delivered
        from (select distinct order_status from feed_orders where order_status is not null)
        union all select -1, 'Unknown', 0""",
    "dim_product": """
        select row_number() over (order by product_id) as product_sk, product_id, p.category as category_pt,
               coalesce(english, 'unknown') as category_en, weight_g, length_cm, height_cm, width_cm
        from products p left join category_translation t on p.category = t.category
        union all select -1, 'UNKNOWN', 'unknown', 'unknown', null, null, null, null""",
    "dim_customer": """
        select row_number() over (order by customer_unique_id) as customer_sk, customer_unique_id,
               max(city) as customer_city, max(state) as customer_state
        from customers group by customer_unique_id
        union all select -1, 'UNKNOWN', 'unknown', 'XX'""",
    "zip_places": """
        select zip, city, state, row_number() over (partition by zip order by count(*) desc, city, state) as rn
        from geolocation group by zip, city, state""",
    "zip_centres": """
        select zip, cast(sum(balance) * 100 as double) / count(*) / 10000 as lat from geolocation group by zip""",
    "dim_geography": """
        select row_number() over (order by c.zip) as geography_sk, c.zip as zip_code_prefix, city, state,
               round(lat, 8) as latitude, round(-lat, 8) as longitude
        from zip_centres c join zip_places p on c.zip = p.zip and rn = 1
        union all select -1, 'UNKNOWN', 'unknown', 'XX', null, null""",
    "dim_seller": """
        select row_number() over (order by seller_id) as seller_sk, seller_id, seller_city, seller_state,
               '1995-01-01' as effective_date, '9999-12-31' as expiry_date, 1 as is_current
        from sellers
        union all select -1, 'UNKNOWN', 'unknown', 'XX', '1900-01-01', '9999-12-31', 1""",
    "seller_versions": """
        select d.seller_sk, d.seller_id, d.seller_city, d.seller_state, d.effective_date,
               case when c then '2001-09-01' else d.expiry_date end as expiry_date,
               case when c then 0 else d.is_current end as is_current
        from (select d.*, f.seller_id is not null and d.is_current = 1
                     and (coalesce(d.seller_city, '') <> coalesce(f.seller_city, '')
                          or coalesce(d.seller_state, '') <> coalesce(f.seller_state, '')) as c
              from dim_seller d left join sellers_feed f on d.seller_id = f.seller_id) d""",
    "sellers_merged": """
        select * from seller_versions
        union all
        select (select max(seller_sk) from seller_versions) + row_number() over (order by seller_id),
               seller_id, seller_city, seller_state, '2001-09-01', '9999-12-31', 1
        from sellers_feed f
        where not exists (select 1 from seller_versions v where v.seller_id = f.seller_id and v.is_current = 1)""",
    "keyed_orders": """
        select o.*, coalesce(cast(strftime(purchased, '%Y%m%d') as bigint), -1) as date_sk,
               coalesce(dc.customer_sk, -1) as customer_sk, coalesce(g.geography_sk, -1) as geography_sk,
               coalesce(s.order_status_sk, -1) as order_status_sk
        from feed_orders o
        left join customers c on o.customer_id = c.customer_id
        left join dim_customer dc on c.customer_unique_id = dc.customer_unique_id
        left join dim_geography g on c.zip = g.zip_code_prefix
        left join dim_order_status s on o.order_status = s.order_status""",
    "fact_order_items": f"""
        select i.order_id, i.order_item_id, coalesce(o.date_sk, -1) as date_sk, coalesce(p.product_sk, -1) as product_sk,
               coalesce(s.seller_sk, -1) as seller_sk, coalesce(o.customer_sk, -1) as customer_sk,
               coalesce(o.geography_sk, -1) as geography_sk, coalesce(o.order_status_sk, -1) as order_status_sk,
               price, freight_value,
               case when price > 0 then {_half_up(_cents("freight_value"), _cents("price"), 4)} end as freight_pct,
               price - freight_value as net_contribution
        from order_items i
        left join keyed_orders o on i.order_id = o.order_id
        left join dim_product p on i.product_id = p.product_id
        left join dim_seller s on i.seller_id = s.seller_id and s.is_current = 1""",
    "fact_payments": """
        select p.order_id, payment_sequential, coalesce(date_sk, -1) as date_sk, coalesce(customer_sk, -1) as customer_sk,
               coalesce(order_status_sk, -1) as order_status_sk, payment_type, payment_installments, payment_value
        from order_payments p left join keyed_orders o on p.order_id = o.order_id""",
    "latest_reviews": """
        select order_id, review_score from (
            select order_id, review_score,
                   row_number() over (partition by order_id order by created desc nulls last, review_id desc) as rn
            from order_reviews) where rn = 1""",
    "fact_delivery_reviews": """
        select o.order_id, customer_sk, order_status_sk, date_sk as purchase_date_sk, review_score,
               date_diff('day', purchased, estimated) as estimated_days,
               date_diff('day', purchased, delivered) as actual_days,
               date_diff('day', estimated, delivered) as delivery_delay_days,
               case when delivered > estimated then 1 else 0 end as is_late,
               case when order_status = 'delivered' then 1 else 0 end as is_delivered
        from keyed_orders o left join latest_reviews r on o.order_id = r.order_id""",
    "rfm_base": """
        select dc.customer_sk, dc.customer_unique_id,
               date_diff('day', max(cast(purchased as date)), (select max(cast(purchased as date)) from feed_orders)) as recency_days,
               count(distinct o.order_id) as frequency, sum(price + freight_value) as monetary
        from dim_customer dc
        join customers c on dc.customer_unique_id = c.customer_unique_id
        join feed_orders o on c.customer_id = o.customer_id
        join order_items i on o.order_id = i.order_id
        where dc.customer_sk > 0
        group by dc.customer_sk, dc.customer_unique_id""",
    "rfm_scores": """
        select *, 6 - ntile(5) over (order by recency_days nulls last, customer_sk) as r_score,
               ntile(5) over (order by frequency nulls last, customer_sk) as f_score,
               ntile(5) over (order by monetary nulls last, customer_sk) as m_score
        from rfm_base""",
    "segment_rules": """
        select * from (values
            (1, 4, 5, 4, 5, 4, 'Champions'), (2, 3, 5, 3, 5, 1, 'Loyal'), (3, 4, 5, 1, 2, 1, 'New / Promising'),
            (4, 3, 5, 1, 5, 4, 'Big Spenders'), (5, 1, 2, 3, 5, 1, 'At Risk'), (6, 1, 2, 1, 5, 4, 'Can''t Lose Them'),
            (7, 1, 2, 1, 2, 1, 'Lost'), (8, 1, 5, 1, 5, 1, 'Needs Attention')
        ) as rules(pos, r_lo, r_hi, f_lo, f_hi, m_lo, label)""",
    "rfm_segments": """
        select customer_sk, customer_unique_id, r_score, f_score, m_score,
               cast(100 * r_score + 10 * f_score + m_score as varchar) as rfm_cell, arg_min(label, pos) as rfm_segment
        from rfm_scores join segment_rules
             on r_score between r_lo and r_hi and f_score between f_lo and f_hi and m_score >= m_lo
        group by all""",
    "dim_customer_segmented": """
        select d.*, coalesce(rfm_segment, 'Unknown') as rfm_segment
        from dim_customer d left join (select customer_sk, rfm_segment from rfm_segments) s on d.customer_sk = s.customer_sk""",
    "mark": """
        select max(purchased) as newest, max(purchased) - interval 30 day as last_mark from feed_orders""",
    "reload_counts": """
        select count(*) as n, cast(sum(price) as decimal(18,2)) as revenue, count(*) filter (where newer) as newer,
               cast(coalesce(sum(price) filter (where newer), 0) as decimal(18,2)) as newer_revenue, count(*) filter (where in_month) as in_months
        from (select price, purchased > (select last_mark from mark) as newer,
                     date_trunc('month', purchased) in (select date_trunc('month', purchased) from feed_orders where purchased > (select last_mark from mark)) as in_month
              from fact_order_items f left join feed_orders o on f.order_id = o.order_id)""",
    "dangling": """
        select 'oi_bad_product' as item, count(*) as value from fact_order_items where product_sk not in (select product_sk from dim_product)
        union all select 'oi_bad_seller', count(*) from fact_order_items where seller_sk not in (select seller_sk from dim_seller)
        union all select 'oi_bad_customer', count(*) from fact_order_items where customer_sk not in (select customer_sk from dim_customer)
        union all select 'oi_bad_geo', count(*) from fact_order_items where geography_sk not in (select geography_sk from dim_geography)
        union all select 'oi_bad_date', count(*) from fact_order_items where date_sk not in (select date_sk from dim_date)
        union all select 'oi_bad_status', count(*) from fact_order_items where order_status_sk not in (select order_status_sk from dim_order_status)
        union all select 'pay_bad_customer', count(*) from fact_payments where customer_sk not in (select customer_sk from dim_customer)
        union all select 'pay_bad_date', count(*) from fact_payments where date_sk not in (select date_sk from dim_date)""",
    "with_unknown": """
        select 'date' as item, count(*) as value from dim_date where date_sk = -1
        union all select 'customer', count(*) from dim_customer where customer_sk = -1
        union all select 'product', count(*) from dim_product where product_sk = -1
        union all select 'seller', count(*) from dim_seller where seller_sk = -1
        union all select 'geography', count(*) from dim_geography where geography_sk = -1
        union all select 'order_status', count(*) from dim_order_status where order_status_sk = -1""",
    "offenders": """
        select 4 as id, 'integrity' as category, 'fact_order_items product_sk valid' as name, value as n
        from dangling where item = 'oi_bad_product'
        union all select 5, 'integrity', 'fact_order_items customer_sk valid', value from dangling where item = 'oi_bad_customer'
        union all select 6, 'integrity', 'fact_order_items date_sk valid', value from dangling where item = 'oi_bad_date'
        union all select 7, 'uniqueness', 'dim_customer unique_id no dupes', count(*) - count(distinct customer_unique_id)
        from dim_customer
        union all select 8, 'uniqueness', 'dim_seller one current per seller_id', count(*) - count(distinct seller_id)
        from dim_seller where is_current = 1
        union all select 9, 'validity', 'no negative prices', count(*) filter (where price < 0) from fact_order_items
        union all select 10, 'validity', 'review scores in 1-5 (staging)', count(*) filter (where review_score not between 1 and 5)
        from order_reviews""",
    "pairs": """
        select 1 as id, 'fact_order_items row count' as name, cast((select count(*) from order_items) as varchar) as expected,
               cast((select count(*) from fact_order_items) as varchar) as actual
        union all
        select 2, 'fact revenue matches staging', cast((select sum(price) from order_items) as varchar),
               cast((select sum(price) from fact_order_items) as varchar)
        union all
        select 3, 'fact_payments row count', cast((select count(*) from order_payments) as varchar),
               cast((select count(*) from fact_payments) as varchar)""",
    "checks": f"""
        select id as check_id, 'reconciliation' as check_category, name as check_name, expected, actual,
               if(expected = actual, 'PASS', 'FAIL') as status from pairs
        union all
        select id, category, name, '0', cast(n as varchar), if(n = 0, 'PASS', 'FAIL') from offenders
        union all
        select 11, 'completeness', 'geography unknown rate', '<5%',
               printf('%.2f', {_half_up("100 * count(*) filter (where geography_sk = -1)", "count(*)", 2)}) || '%',
               if(20 * count(*) filter (where geography_sk = -1) < count(*), 'PASS', 'WARN')
        from fact_order_items""",
    "delay_bands": """
        select * from (values (null, -5, '5+ days early'), (-4, -1, 'Early'), (0, 0, 'On time'), (1, 5, '1-5 days late'),
            (6, null, '5+ days late')) as bands(lo, hi, delivery_bucket)""",
}

_FREIGHT = """cast(sum(price) as double) as revenue, cast(sum(freight_value) as double) as freight,
    case when sum(price) > 0 then round(cast(sum(freight_value) as double) / cast(sum(price) as double), 6) end as freight_share"""

_FACT_ITEM_COLUMNS = """order_id, order_item_id, date_sk, product_sk, seller_sk, customer_sk, geography_sk, order_status_sk,
    cast(price as double) as price, cast(freight_value as double) as freight_value, freight_pct,
    cast(net_contribution as double) as net_contribution"""

_PAYMENT_COLUMNS = """order_id, payment_sequential, date_sk, customer_sk, order_status_sk, payment_type, payment_installments,
    cast(payment_value as double) as payment_value"""

QUERIES = {
    "load_counts": """
        select 'customers' as table_name, count(*) as rows from customers
        union all select 'geolocation', count(*) from geolocation
        union all select 'orders', count(*) from feed_orders
        union all select 'order_items', count(*) from order_items
        union all select 'order_payments', count(*) from order_payments
        union all select 'order_reviews', count(*) from order_reviews
        union all select 'products', count(*) from products
        union all select 'sellers', count(*) from sellers
        union all select 'category_translation', count(*) from category_translation""",
    "profile_grain": """
        select 'customers' as table_name, count(*) as total, count(distinct customer_id) as distinct_key,
               count(distinct customer_unique_id) as distinct_other from customers
        union all select 'orders', count(*), count(distinct order_id), null from feed_orders
        union all select 'products', count(*), count(distinct product_id), null from products
        union all select 'sellers', count(*), count(distinct seller_id), null from sellers
        union all select 'order_reviews', count(*), count(distinct review_id), count(distinct order_id) from order_reviews
        union all select 'geolocation', count(*), count(distinct zip), null from geolocation""",
    "profile_composite_key": """
        select 'order_items' as table_name, count(*) as total, count(distinct order_id) as distinct_orders,
               count(distinct concat(order_id, '-', order_item_id)) as distinct_key from order_items
        union all
        select 'order_payments', count(*), count(distinct order_id),
               count(distinct concat(order_id, '-', payment_sequential)) from order_payments""",
    "profile_sketches": """
        select 'order_id' as key, count(distinct order_id) as distinct_values, true as sketch_is_near from order_items
        union all select 'product_id', count(distinct product_id), true from order_items
        union all select 'item', count(distinct concat(order_id, '-', order_item_id)), true from order_items""",
    "profile_nulls": """
        select count(*) filter (where delivered is null) as null_delivered,
               count(*) filter (where order_status = 'canceled' or purchased is null) as null_approved,
               count(*) filter (where order_status <> 'delivered') as null_carrier, count(*) as total
        from feed_orders""",
    "profile_price_ranges": """
        select cast(min(price) as double) as min_price, cast(max(price) as double) as max_price,
               cast(min(freight_value) as double) as min_freight, cast(max(freight_value) as double) as max_freight,
               count(*) filter (where freight_value = 0) as zero_freight_rows
        from order_items""",
    "status_distribution": "select order_status, count(*) as cnt from feed_orders group by order_status",
    "review_score_distribution": "select review_score, count(*) as cnt from order_reviews group by review_score",
    "products_without_category": """
        select count(*) filter (where category is null or category = '') as products_no_category from products""",
    "orphan_counts": """
        select 'items_without_order' as relation, count(*) as found from order_items i
            where not exists (select 1 from feed_orders o where o.order_id = i.order_id)
        union all select 'items_without_product', count(*) from order_items i
            where not exists (select 1 from products p where p.product_id = i.product_id)
        union all select 'items_without_seller', count(*) from order_items i
            where not exists (select 1 from sellers s where s.seller_id = i.seller_id)
        union all select 'orders_without_customer', count(*) from feed_orders o
            where not exists (select 1 from customers c where c.customer_id = o.customer_id)
        union all select 'orders_without_items', count(*) from feed_orders o
            where not exists (select 1 from order_items i where i.order_id = o.order_id)
        union all select 'orders_without_review', count(*) from feed_orders o
            where not exists (select 1 from order_reviews r where r.order_id = o.order_id)
        union all select 'orders_without_payment', count(*) from feed_orders o
            where not exists (select 1 from order_payments p where p.order_id = o.order_id)""",
    "orphan_items": """
        select i.order_id, order_item_id, cast(price as double) as price
        from order_items i left join feed_orders o on i.order_id = o.order_id where o.order_id is null""",
    "orders_without_items": """
        select o.order_id, order_status from feed_orders o
        where not exists (select 1 from order_items i where i.order_id = o.order_id)""",
    "untranslated_categories": """
        select distinct p.category as product_category_name
        from products p left join category_translation t on p.category = t.category
        where t.category is null and p.category is not null""",
    "dim_date": f"select * {_whole('is_weekend', 'is_holiday')} from dim_date",
    "holiday_list": "select full_date, holiday_name from dim_date where is_holiday = 1",
    "weekday_counts": "select weekday_name, cast(is_weekend as bigint) as is_weekend, count(*) as cnt from dim_date group by all",
    "dim_order_status": f"select * {_whole('is_delivered')} from dim_order_status",
    "dim_product": f"select * {_whole('weight_g', 'length_cm', 'height_cm', 'width_cm')} from dim_product",
    "unknown_category_products": """
        select count(*) as with_unknown_member, count(*) filter (where product_sk > 0) as real_products
        from dim_product where category_en = 'unknown'""",
    "dim_customer": "select * from dim_customer",
    "dim_customer_latest": """
        select row_number() over (order by customer_unique_id) as customer_sk, customer_unique_id, city as customer_city, state as customer_state,
               cast(null as varchar) as rfm_segment
        from (select *, row_number() over (partition by customer_unique_id order by last_order desc nulls last, customer_id desc) as rn
              from customers c left join (select customer_id as cid, max(purchased) as last_order from feed_orders group by all) o on c.customer_id = o.cid)
        where rn = 1
        union all select -1, 'UNKNOWN', 'unknown', 'XX', null""",
    "dim_geography": "select * from dim_geography",
    "scd2_init": f"select * {_whole('is_current')} from dim_seller",
    "scd2_merge": f"select * {_whole('is_current')} from sellers_merged",
    "seller_version_counts": "select cast(is_current as bigint) as is_current, count(*) as cnt from sellers_merged group by all",
    "fact_order_items": f"select {_FACT_ITEM_COLUMNS} from fact_order_items",
    "fact_payments": f"select {_PAYMENT_COLUMNS} from fact_payments",
    "fact_delivery_reviews": f"select * {_whole('is_late', 'is_delivered')} from fact_delivery_reviews",
    "fact_order_items_keyed": f"""
        select row_number() over (order by order_id, order_item_id) as order_item_sk, {_FACT_ITEM_COLUMNS} from fact_order_items""",
    "fact_payments_keyed": f"""
        select row_number() over (order by order_id, payment_sequential) as payment_sk, {_PAYMENT_COLUMNS} from fact_payments""",
    "fact_delivery_reviews_keyed": f"""
        select row_number() over (order by order_id) as delivery_review_sk, * {_whole("is_late", "is_delivered")}
        from fact_delivery_reviews""",
    "unknown_routing": """
        select count(*) filter (where product_sk = -1) as unk_product, count(*) filter (where seller_sk = -1) as unk_seller,
               count(*) filter (where customer_sk = -1) as unk_customer, count(*) filter (where geography_sk = -1) as unk_geography,
               count(*) filter (where date_sk = -1) as unk_date, count(*) filter (where order_status_sk = -1) as unk_status
        from fact_order_items""",
    "freight_overall": f"select {_FREIGHT} from fact_order_items",
    "freight_by_category": f"""
        select category_en, count(*) as items, {_FREIGHT}
        from fact_order_items f join dim_product d on f.product_sk = d.product_sk group by category_en""",
    "freight_by_state": f"""
        select state, count(*) as items, {_FREIGHT}
        from fact_order_items f join dim_geography d on f.geography_sk = d.geography_sk group by state""",
    "freight_heavy_items": """
        select count(*) as items, count(*) filter (where freight_value * 2 > price) as heavy_items,
               round(count(*) filter (where freight_value * 2 > price) / count(*), 6) as heavy_share
        from fact_order_items where price > 0""",
    "freight_over_price_products": """
        select count(distinct product_sk) as products from fact_order_items where freight_value > price and product_sk <> -1""",
    "items_per_order": """
        select orders_with_items, items, round(items / orders_with_items, 6) as items_per_order, multi_item_orders,
               round(multi_item_orders / orders_with_items, 6) as multi_item_share,
               (select count(*) from feed_orders) as all_orders,
               round(items / (select count(*) from feed_orders), 6) as items_per_any_order
        from (select count(*) as orders_with_items, cast(sum(n) as bigint) as items, count(*) filter (where n > 1) as multi_item_orders
              from (select order_id, count(*) as n from fact_order_items group by order_id))""",
    "repeat_customers": """
        select count(distinct customer_unique_id) as people,
               count(*) - count(distinct customer_unique_id) as surplus_records,
               (select count(distinct customer_sk) from fact_delivery_reviews where customer_sk <> -1) as people_with_orders,
               (select count(*) from (select customer_sk from fact_delivery_reviews where customer_sk <> -1
                                      group by customer_sk having count(*) > 1)) as people_with_several_orders
        from customers""",
    "delivery_rate": """
        select count(*) as orders, count(*) filter (where is_delivered = 1) as delivered,
               round(count(*) filter (where is_delivered = 1) / count(*), 6) as delivery_rate
        from fact_delivery_reviews""",
    "monthly_trend": f"""
        select year, month, count(*) as items, {_FREIGHT}
        from fact_order_items f join dim_date d on f.date_sk = d.date_sk
        where full_date between '1996-01-01' and '2000-12-31' group by year, month""",
    "payments_total": """
        select count(*) as payments, cast(sum(payment_value) as double) as payment_value from fact_payments""",
    "payments_by_type": """
        select payment_type, count(*) as payments, cast(sum(payment_value) as double) as payment_value,
               cast(sum(payment_installments) as bigint) as installments, max(payment_installments) as max_installments
        from fact_payments group by payment_type""",
    "payments_by_installments": """
        select payment_installments, count(*) as payments, cast(sum(payment_value) as double) as payment_value
        from fact_payments group by payment_installments""",
    "score_by_late": f"""
        select cast(is_late as bigint) as is_late, count(*) as orders,
               {_half_up("sum(review_score)", "count(*)", 2)} as avg_review_score,
               {_half_up("sum(delivery_delay_days)", "count(delivery_delay_days)", 1)} as avg_delay_days
        from fact_delivery_reviews where is_delivered = 1 and review_score is not null group by is_late""",
    "score_by_delay_bucket": f"""
        select delivery_bucket, count(*) as orders, {_half_up("sum(review_score)", "count(*)", 2)} as avg_score
        from fact_delivery_reviews join delay_bands on delivery_delay_days >= coalesce(lo, delivery_delay_days) and delivery_delay_days <= coalesce(hi, delivery_delay_days)
        where is_delivered = 1 and review_score is not null group by delivery_bucket""",
    "rfm_base": """
        select customer_sk, customer_unique_id, recency_days, frequency, cast(monetary as double) as monetary from rfm_base""",
    "rfm_summary": f"""
        select count(*) as customers, cast(sum(recency_days) // count(recency_days) as bigint) as avg_recency,
               {_half_up("sum(frequency)", "count(*)", 4)} as avg_frequency,
               {_half_up(_cents("sum(monetary)"), "count(monetary) * 100", 4)} as avg_monetary
        from rfm_base""",
    "rfm_scores": """
        select customer_sk, customer_unique_id, recency_days, frequency, cast(monetary as double) as monetary,
               r_score, f_score, m_score from rfm_scores""",
    "rfm_segments": "select * from rfm_segments",
    "rfm_top_spenders": """
        select customer_sk, customer_unique_id, recency_days, frequency, cast(monetary as double) as monetary,
               r_score, f_score, m_score from rfm_scores order by monetary desc, customer_sk limit 10""",
    "dim_customer_segmented": "select * from dim_customer_segmented",
    "segment_distribution": """
        select rfm_segment, count(*) as customers from dim_customer_segmented group by rfm_segment""",
    "segment_spend": f"""
        select rfm_segment, count(*) as customers, {_half_up(_cents("sum(monetary)"), "count(monetary) * 100", 2)} as avg_spend
        from rfm_segments s join rfm_base b on s.customer_sk = b.customer_sk group by rfm_segment""",
    "segment_satisfaction": f"""
        select rfm_segment, count(*) as orders, count(review_score) as scored_orders,
               case when count(review_score) > 0
                    then {_half_up("sum(review_score)", "greatest(count(review_score), 1)", 2)} end as avg_score
        from fact_delivery_reviews f join dim_customer_segmented d on f.customer_sk = d.customer_sk group by rfm_segment""",
    "dq_staging_checks": """
        select 'orders_row_count' as check_name, cast(count(*) as varchar) as check_result,
               case when count(*) = (select count(*) from orders) then 'PASS' else 'WARN' end as check_status from feed_orders
        union all
        select 'orphaned_order_items', cast(count(*) as varchar), case when count(*) = 0 then 'PASS' else 'WARN' end
        from order_items i left join feed_orders o on i.order_id = o.order_id where o.order_id is null""",
    "dq_checks": f"select * {_whole('check_id')} from checks",
    "dq_status_summary": "select status, count(*) as checks from checks group by status",
    "unknown_members": "select * from with_unknown",
    "dangling_keys": "select * from dangling",
    "final_validation": """
        select 'rows' as section, item, value from (
            select 'dim_date' as item, count(*) as value from dim_date
            union all select 'dim_customer', count(*) from dim_customer
            union all select 'dim_product', count(*) from dim_product
            union all select 'dim_seller', count(*) from dim_seller
            union all select 'dim_geography', count(*) from dim_geography
            union all select 'dim_order_status', count(*) from dim_order_status
            union all select 'fact_order_items', count(*) from fact_order_items
            union all select 'fact_payments', count(*) from fact_payments)
        union all select 'unknown_member', item, value from with_unknown
        union all select 'dangling_keys', item, value from dangling
        union all select 'segments', 'null_segments', count(*) filter (where rfm_segment is null) from dim_customer_segmented
        union all select 'segments', 'distinct_segments', count(distinct rfm_segment) from dim_customer_segmented
        union all select 'check_status', status, count(*) from checks group by status""",
    "incremental_expected": """
        select count(*) as expected_new_rows from order_items i join feed_orders o on i.order_id = o.order_id
        where purchased > (select last_mark from mark)""",
    "incremental_undated": """
        select count(*) as undated_items from order_items i left join feed_orders o on i.order_id = o.order_id
        where purchased is null""",
    "incremental_loaded": f"""
        select f.*, cast(case when purchased > (select last_mark from mark) then 2 else 1 end as bigint) as load_batch
        from (select {_FACT_ITEM_COLUMNS} from fact_order_items) f left join feed_orders o on f.order_id = o.order_id""",
    "incremental_keyed": """
        select row_number() over (order by load_batch, order_id, order_item_id) as order_item_sk, order_id, order_item_id, load_batch
        from (select f.order_id, order_item_id, cast(case when purchased > (select last_mark from mark) then 2 else 1 end as bigint) as load_batch
              from fact_order_items f left join feed_orders o on f.order_id = o.order_id)""",
    "incremental_reload": """
        select 'increment' as step, newer as rows_loaded, n as fact_rows, cast(revenue as double) as revenue from reload_counts
        union all select 'reload', 0, n, cast(revenue as double) from reload_counts
        union all select 'append_again', newer, n + newer, cast(revenue + newer_revenue as double) from reload_counts
        union all select 'replace_months', in_months, n, cast(revenue as double) from reload_counts""",
    "load_control_after": """
        select 'fact_order_items' as table_name, strftime((select newest from mark), '%Y-%m-%d %H:%M:%S') as last_watermark,
               '2002-01-01 00:00:00' as last_load_time, count(*) as rows_last_loaded
        from order_items i join feed_orders o on i.order_id = o.order_id where purchased > (select last_mark from mark)""",
    "incremental_stream": f"select {_FACT_ITEM_COLUMNS} from fact_order_items",
    "quarantine_report": """
        select 'orders' as feed, count(*) as repeated_keys, 2 * count(*) as rows from feed_orders where order_status = 'canceled'
        union all select 'customers', count(*), 2 * count(*) from customers where city = 'BUILDING'""",
    "fact_after_quarantine": """
        select case o.order_status when 'canceled' then 'shipped' else coalesce(o.order_status, 'Unknown') end as order_status,
               count(*) as items, count(*) filter (where f.customer_sk > 0) as with_customer, cast(sum(price) as double) as revenue
        from fact_order_items f left join feed_orders o on f.order_id = o.order_id group by 1""",
    "csv_load_counts": """
        select 'customers' as table_name, count(*) as rows, 0 as rejected, cast(sum(length(customer_id)) as bigint) as characters from customers
        union all select 'geolocation', count(*), 0, cast(sum(length(zip)) as bigint) from geolocation
        union all select 'orders', count(*), 0, cast(sum(length(order_id)) as bigint) from feed_orders
        union all select 'order_items', count(*), 0, cast(sum(length(order_id)) as bigint) from order_items
        union all select 'order_payments', count(*), 0, cast(sum(length(order_id)) as bigint) from order_payments
        union all select 'order_reviews', count(*) filter (where cast(review_id as bigint) >= 7), count(*) filter (where cast(review_id as bigint) < 7),
                         cast(sum(length(review_id)) filter (where cast(review_id as bigint) >= 7) as bigint) from order_reviews
        union all select 'products', count(*), 0, cast(sum(length(product_id)) as bigint) from products
        union all select 'sellers', count(*), 0, cast(sum(length(seller_id)) as bigint) from sellers
        union all select 'category_translation', count(*), 0, cast(sum(length(category)) as bigint) from category_translation""",
    "warehouse_build": """
        select 'dim_date' as table_name, count(*) as rows from dim_date
        union all select 'dim_order_status', count(*) from dim_order_status
        union all select 'dim_product', count(*) from dim_product
        union all select 'dim_customer', count(*) from dim_customer
        union all select 'dim_geography', count(*) from dim_geography
        union all select 'dim_seller', count(*) from dim_seller
        union all select 'fact_order_items', count(*) from fact_order_items
        union all select 'fact_payments', count(*) from fact_payments
        union all select 'fact_delivery_reviews', count(*) from fact_delivery_reviews""",
    "dq_results_stored": f"select * {_whole('check_id')}, '2002-01-01 00:00:00' as checked_at from checks",
    "csv_text_load": """
        select cast(doc_id as varchar) as review_id, 1 + n_chars % 5 as review_score,
               lang || ', ' || source as review_comment_title, length(text) as chars, md5(text) as digest
        from documents""",
    "csv_accent_check": """
        select distinct lang || ', ' || source as review_comment_title from documents
        where text like '%á%' or text like '%ç%' or text like '%é%' or text like '%ã%'""",
    "csv_text_peek": """
        select cast(doc_id as varchar) as review_id, text as review_comment_message from documents
        where length(rtrim(text, ' ')) > 20 order by review_id limit 5""",
    "csv_rejects": """
        select 'loaded' as outcome, count(*) as rows, cast(sum(payment_value) as double) as payment_value
        from order_payments where payment_type <> 'error'
        union all
        select 'rejected', count(*), cast(sum(payment_value) as double) from order_payments where payment_type = 'error'""",
    "purchase_date_range": """
        select strftime(min(purchased), '%Y-%m-%d %H:%M:%S') as earliest, strftime(max(purchased), '%Y-%m-%d %H:%M:%S') as latest,
               count(*) filter (where purchased is null) as unparseable
        from feed_orders""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it needs, each before its first use."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                add(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} as ({VIEWS[name]})" for name in needed)
    return f"with {views}\n{sql}"


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in QUERIES.items()}
