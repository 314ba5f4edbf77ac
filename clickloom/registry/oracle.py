"""The registered queries as DuckDB SQL over the same test tables.

Written from the definitions of the results, not from the Spark code: plain joins and window
functions, none of the rewrites the operators use.
"""

from __future__ import annotations

import re

# Shared table expressions; each may use the ones before it.
_CTES = {
    "events_k": """
        select event_id, user_id, event_type,
               epoch_us(ts) // 1000000 as es, epoch_us(ts) // 1000 as ms,
               cast(json_extract_string(props, '$.k') as bigint) as k,
               case user_id % 10 when 0 then 30 when 1 then 10 when 2 then 5 else 1 end
                   * 86400 as span,
               case user_id % 5 when 0 then 1 when 1 then 10 when 2 then 100 when 3 then 1000
                   else 10000 end as pace
        from events""",
    "events_seg": """
        select *, (es - 1704067200) // span as seg,
               1704067200 + ((es - 1704067200) // span) * span as base
        from events_k""",
    "user_visit_action": """
        select cast(act as date) as date, user_id,
               's' || user_id || '-' || seg as session_id,
               (event_id * 7 + user_id) % 10 as page_id,
               act as action_time,
               case when event_type = 'signup' then 'kw' || (k % 12) end as search_keyword,
               case when event_type = 'click' then k else -1 end as click_category_id,
               case when event_type = 'click' then (k * 7 + event_id) % 100 else -1 end
                   as click_product_id,
               case when event_type = 'error'
                   then k || ',' || ((k + event_id % 2) % 100) end as order_category_ids,
               case when event_type = 'error' then cast((k * 3) % 100 as varchar) end
                   as order_product_ids,
               case when event_type = 'purchase' then cast(k as varchar) end as pay_category_ids,
               case when event_type = 'purchase' then cast((k * 3) % 100 as varchar) end
                   as pay_product_ids,
               event_id % 11 as city_id
        from (select *, make_timestamp((base + (user_id % 24) * 3600 + (es - base) // pace)
                                       * 1000000) as act
              from events_seg)""",
    "user_info": """
        select c_custkey as user_id, 'user' || c_custkey as username, c_name as name,
               cast(18 + (c_custkey * 7) % 43 as integer) as age, c_mktsegment as professional,
               'city' || c_nationkey as city,
               case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
        from customer""",
    "product_info": """
        select p_partkey as product_id, p_name || ' ' || p_partkey as product_name,
               '{"product_status": ' || (p_size % 2) || '}' as extend_info
        from part""",
    "city_info": """
        select cast(city_id as bigint) as city_id, city_name, area from (values
            (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
            (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
            (8, '成都', '西南'), (9, '哈尔滨', '东北')) c(city_id, city_name, area)""",
    "actions": """
        select * from user_visit_action
        where date between date '2024-01-03' and date '2024-01-28'""",
    "summary": """
        select s.*, u.age, u.professional, u.sex, u.city
        from (select session_id, min(user_id) as user_id, min(action_time) as start_time,
                     max(action_time) as end_time,
                     cast(epoch(max(action_time)) - epoch(min(action_time)) as bigint)
                         as visit_length,
                     count(*) as step_length,
                     list(distinct search_keyword) filter (where search_keyword <> '')
                         as keywords,
                     list(distinct click_category_id) filter (where click_category_id <> -1)
                         as categories
              from actions group by session_id) s
        join user_info u on u.user_id = s.user_id""",
    "kept": """
        select * from summary
        where age between 20 and 50 and sex = 'male'
          and professional in ('BUILDING', 'MACHINERY')""",
    "kept_by_interest": """
        select * from kept
        where list_has_any(keywords, ['kw1', 'kw3', 'kw7'])
          and list_has_any(categories, [1, 3, 5, 7, 11, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29,
                                        50, 51, 52, 53, 54, 55, 56, 57, 58, 59])""",
    "kept_actions": """
        select a.* from actions a where a.session_id in (select session_id from kept)""",
    "hours": """
        select cast(start_time as date) as date, cast(hour(start_time) as integer) as hour,
               count(*) as session_count
        from kept group by all""",
    "quota": """
        select *, least(session_count, cast(floor(
                   cast(session_count as double) / day_count * per_day + 0.5) as bigint)) as quota
        from (select date, hour, session_count,
                     cast(sum(session_count) over (partition by date) as bigint) as day_count,
                     (select cast(100 // count(distinct date) as bigint) from hours) as per_day
              from hours)""",
    "drawn": """
        select session_id from (
            select k.session_id, q.quota,
                   row_number() over (partition by q.date, q.hour
                                      order by md5(k.session_id || '-0'), k.session_id) as place
            from kept k
            join quota q on q.date = cast(k.start_time as date) and q.hour = hour(k.start_time))
        where place <= quota""",
    "clicked": """
        select click_category_id as category_id, count(*) as click_count
        from kept_actions where click_category_id <> -1 group by 1""",
    "ordered": """
        select category_id, count(*) as order_count
        from (select cast(unnest(string_split(order_category_ids, ',')) as bigint) as category_id
              from kept_actions where order_category_ids is not null) group by 1""",
    "paid": """
        select category_id, count(*) as pay_count
        from (select cast(unnest(string_split(pay_category_ids, ',')) as bigint) as category_id
              from kept_actions where pay_category_ids is not null) group by 1""",
    "universe": """
        select category_id from clicked union select category_id from ordered
        union select category_id from paid""",
    "category_totals": """
        select category_id, coalesce(click_count, 0) as click_count,
               coalesce(order_count, 0) as order_count, coalesce(pay_count, 0) as pay_count
        from universe left join clicked using (category_id) left join ordered using (category_id)
        left join paid using (category_id)""",
    "top_categories": """
        select * from category_totals
        order by click_count desc, order_count desc, pay_count desc, category_id limit 10""",
    "category_sessions": """
        select click_category_id as category_id, session_id, count(*) as click_count
        from kept_actions where click_category_id <> -1 group by all""",
    "pairs": """
        select * from (
            select session_id, action_time, page_id,
                   lead(page_id) over (partition by session_id order by action_time, page_id)
                       as next_page_id
            from actions)
        where next_page_id is not null""",
    "flow": """
        select cast(i as integer) as step, cast(i + 1 as bigint) as page_id,
               cast(i + 2 as bigint) as next_page_id from range(6) t(i)""",
    "flow_counts": """
        select f.step, f.page_id, f.next_page_id, count(p.session_id) as pair_count
        from flow f left join pairs p on p.page_id = f.page_id
         and p.next_page_id = f.next_page_id
        group by all""",
    "arrivals": "select count(*) as start_count from actions where page_id = 1",
    "product_clicks": """
        select city_id, click_product_id from actions where click_product_id <> -1""",
    "clicks_by_area": """
        select c.city_id, c.city_name, c.area, p.click_product_id as product_id
        from product_clicks p join city_info c on c.city_id = p.city_id""",
    "area_counts": """
        select area, product_id, count(*) as click_count,
               string_agg(distinct city_id || ':' || city_name, ','
                          order by city_id || ':' || city_name) as city_infos
        from clicks_by_area group by area, product_id""",
    "area_info": """
        select a.area, a.city_infos, a.product_id, p.product_name,
               case when json_extract_string(p.extend_info, '$.product_status') = '0'
                   then 'self' else 'others' end as product_status,
               a.click_count
        from area_counts a join product_info p on p.product_id = a.product_id""",
    "clicks": """
        select make_timestamp(ms * 1000) as click_time,
               cast(make_timestamp(ms * 1000) as date) as date,
               cast(user_id % 10 as varchar) as province, cast(user_id % 10 as varchar) as city,
               user_id as userid, k % 4 as adid
        from events_k""",
    "user_counts_all": """
        select date, userid, adid, count(*) as clicks from clicks group by all""",
    "barred": """
        select userid, min(date) as barred_after from user_counts_all where clicks >= 4 group by userid""",
    "admitted": """
        select c.* from clicks c left join barred b on b.userid = c.userid
        where b.userid is null or c.date <= b.barred_after""",
    "region_counts": """
        select date, province, city, adid, count(*) as n from admitted group by all""",
    "province_counts": """
        select date, province, adid, cast(sum(n) as bigint) as n from region_counts
        group by all""",
    "province_top": """
        select date, province, adid, n from (
            select *, row_number() over (partition by date, province order by n desc, adid)
                as place from province_counts)
        where place <= 3""",
    "minutes": """
        select date_trunc('minute', click_time) as minute_start, adid, count(*) as n
        from admitted group by all""",
    "first_top": """
        select date, province, adid, n from (
            select *, row_number() over (partition by date, province order by n desc, adid)
                as place
            from (select date, province, adid, count(*) as n from clicks
                  group by all))
        where place <= 3""",
    "late_top": """
        select date, province, adid, n from (
            select *, row_number() over (partition by date, province order by n desc, adid)
                as place
            from (select date, province, adid, count(*) as n from admitted
                  where date >= date '2024-01-15' group by all))
        where place <= 3""",
}

_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"
_DAY = "strftime(date, '%Y-%m-%d') as date"
_CLICK_TIME = "strftime(click_time, '%Y-%m-%d %H:%M:%S.%g') as click_time"

_ACTION_COLUMNS = (
    f"{_DAY}, user_id, session_id, page_id, {_TIME.format('action_time')}, search_keyword, "
    "click_category_id, click_product_id, order_category_ids, order_product_ids, "
    "pay_category_ids, pay_product_ids, city_id")
_SESSION_COLUMNS = (
    f"session_id, user_id, {_TIME.format('start_time')}, {_TIME.format('end_time')}, "
    "visit_length, step_length, array_to_string(list_sort(keywords), ',') as search_keywords, "
    "array_to_string(list_sort(categories), ',') as click_category_ids, "
    "age, professional, sex, city")
_CLICK_COLUMNS = f"{_CLICK_TIME}, {_DAY}, province, city, userid, adid"

_CLASSES = (
    ("visit_length_1s_3s", "visit_length >= 1 and visit_length <= 3"),
    ("visit_length_4s_6s", "visit_length >= 4 and visit_length <= 6"),
    ("visit_length_7s_9s", "visit_length >= 7 and visit_length <= 9"),
    ("visit_length_10s_30s", "visit_length >= 10 and visit_length <= 30"),
    ("visit_length_30s_60s", "visit_length > 30 and visit_length <= 60"),
    ("visit_length_1m_3m", "visit_length > 60 and visit_length <= 180"),
    ("visit_length_3m_10m", "visit_length > 180 and visit_length <= 600"),
    ("visit_length_10m_30m", "visit_length > 600 and visit_length <= 1800"),
    ("visit_length_30m", "visit_length > 1800"),
    ("step_length_1_3", "step_length >= 1 and step_length <= 3"),
    ("step_length_4_6", "step_length >= 4 and step_length <= 6"),
    ("step_length_7_9", "step_length >= 7 and step_length <= 9"),
    ("step_length_10_30", "step_length >= 10 and step_length <= 30"),
    ("step_length_30_60", "step_length > 30 and step_length <= 60"),
    ("step_length_60", "step_length > 60"),
)
_BUCKETS = "select count(*) as session_count, " + ", ".join(
    f"count(*) filter (where {condition}) as {name}" for name, condition in _CLASSES)


def _ratio(task: str, kept: str) -> str:
    # Half up in whole numbers: rounding of doubles differs between the engines.
    shares = ", ".join(
        f"case when session_count = 0 then 0.0::double else "
        f"((200 * {name} + session_count) // (2 * session_count)) / 100.0::double end "
        f"as {name}_ratio" for name, _ in _CLASSES)
    return (f"select '{task}' as taskid, session_count, {shares} "
            f"from ({_BUCKETS} from {kept})")


_RECENT_HOUR = """
    select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start,
           strftime(w + interval 60 minute, '%Y-%m-%d %H:%M:%S') as window_end, adid,
           cast(sum(n) as bigint) as "clickCount"
    from (select minute_start - to_minutes(i) as w, adid, n
          from minutes, range(60) t(i))
    group by w, adid"""
_TREND = f"""
    select {_DAY}, strftime(minute_start, '%H') as hour, strftime(minute_start, '%M') as minute,
           adid, n as "clickCount"
    from (select cast(minute_start as date) as date, * from minutes)"""
_USER_CLICKS = f"""
    select {_DAY}, userid, adid, count(*) as "clickCount" from admitted group by date, userid, adid"""
_REGIONS = f'select {_DAY}, province, city, adid, n as "clickCount" from region_counts'
_PROVINCE_TOP = f'select {_DAY}, province, adid, n as "clickCount" from province_top'
_BLACKLIST = "select userid from barred"
_ADMITTED = f"select {_CLICK_COLUMNS} from admitted"
_CATEGORIES = "select category_id, click_count, order_count, pay_count from category_totals"

_SELECTS = {
    "actions_in_range": f"select {_ACTION_COLUMNS} from actions",
    "product_clicks_in_range": "select city_id, click_product_id from product_clicks",
    "ingest_deliveries": f"select {_ACTION_COLUMNS} from user_visit_action",
    "day_and_minute_keys": """
        select strftime(date, '%Y%m%d') as day_key, strftime(action_time, '%Y%m%d%H%M') as minute_key,
               count(*) as n, strftime(date, '%Y-%m-%d') as date
        from user_visit_action group by 1, 2, 4""",
    "sql_functions": """
        select product_id, c.city_id || ':' || city_name as city,
               json_extract_string(extend_info, '$.product_status') as status
        from product_info p join city_info c on c.city_id = p.product_id % 10""",
    "sessions_of_json_task": f"select {_SESSION_COLUMNS} from kept",
    "session_summary": f"select {_SESSION_COLUMNS} from summary",
    "filtered_sessions": f"select {_SESSION_COLUMNS} from kept",
    "filtered_sessions_by_interest": f"select {_SESSION_COLUMNS} from kept_by_interest",
    "filtered_actions": f"select {_ACTION_COLUMNS} from kept_actions",
    "session_bucket_counts": f"{_BUCKETS} from kept",
    "session_ratio": _ratio("task-1", "kept"),
    "session_hour_counts": f"select {_DAY}, hour, session_count from hours",
    "session_extract_quota":
        f"select {_DAY}, hour, session_count, day_count, per_day, quota from quota",
    "session_extract": """
        select 'task-1' as taskid, session_id as sessionid,
               strftime(start_time, '%Y-%m-%d %H:%M:%S') as "startTime",
               array_to_string(list_sort(keywords), ',') as "searchKeywords",
               array_to_string(list_sort(categories), ',') as "clickCategoryIds"
        from kept where session_id in (select session_id from drawn)""",
    "session_extract_detail": """
        select 'task-1' as taskid, user_id as userid, session_id as sessionid,
               page_id as pageid, strftime(action_time, '%Y-%m-%d %H:%M:%S') as "actionTime",
               search_keyword as "searchKeyword", click_category_id as "clickCategoryId",
               click_product_id as "clickProductId", order_category_ids as "orderCategoryIds",
               order_product_ids as "orderProductIds", pay_category_ids as "payCategoryIds",
               pay_product_ids as "payProductIds"
        from actions where session_id in (select session_id from drawn)""",
    "click_category_counts": "select * from clicked",
    "order_category_counts": "select * from ordered",
    "pay_category_counts": "select * from paid",
    "category_universe": "select category_id from universe",
    "category_counts": _CATEGORIES,
    "top10_categories": """
        select 'task-1' as taskid, category_id as categoryid, click_count as "clickCount",
               order_count as "orderCount", pay_count as "payCount" from top_categories""",
    "category_session_counts": "select category_id, session_id, click_count from category_sessions",
    "top10_sessions": """
        select 'task-1' as taskid, category_id as categoryid, session_id as sessionid,
               click_count as "clickCount"
        from (select *, row_number() over (partition by category_id
                                           order by click_count desc, session_id) as place
              from category_sessions
              where category_id in (select category_id from top_categories))
        where place <= 10""",
    "page_pairs": f"""
        select session_id, {_TIME.format('action_time')}, page_id, next_page_id,
               count(*) as pair_count
        from pairs group by pairs.session_id, pairs.action_time, pairs.page_id,
                            pairs.next_page_id""",
    "page_pair_counts":
        "select page_id, next_page_id, pair_count from flow_counts where pair_count > 0",
    "start_page_count": "select start_count from arrivals",
    "page_conversion": """
        select step, page_id, next_page_id, pair_count,
               case when before > 0 then pair_count / cast(before as double) else 0.0::double end
                   as rate
        from (select *, coalesce(lag(pair_count) over (order by step), start_count) as before
              from flow_counts, arrivals)""",
    "page_conversion_report": """
        select 'task-1' as taskid, page_id || '_' || next_page_id || ':' || rate as "convertRate"
        from (select step, page_id, next_page_id, pair_count,
               case when before > 0 then pair_count / cast(before as double) else 0.0::double end
                   as rate
        from (select *, coalesce(lag(pair_count) over (order by step), start_count) as before
              from flow_counts, arrivals))""",
    "area_clicks": "select city_id, city_name, area, product_id from clicks_by_area",
    "area_product_counts": "select area, product_id, click_count, city_infos from area_counts",
    "area_product_info": "select * from area_info",
    "area_top3_products": """
        select 'task-1' as taskid, area,
               case when area in ('华北', '华东') then 'A Level'
                    when area in ('华南', '华中') then 'B Level'
                    when area in ('西南', '西北') then 'C Level' else 'D Level' end as "areaLevel",
               product_id as productid, city_infos as "cityInfos", click_count as "clickCount",
               product_name as "productName", product_status as "productStatus"
        from (select *, row_number() over (partition by area
                                           order by click_count desc, product_id) as place
              from area_info)
        where place <= 3""",
    "ad_log_parsed": f"select {_CLICK_COLUMNS} from clicks",
    "ad_clicks_admitted": _ADMITTED,
    "ad_user_daily_clicks": _USER_CLICKS,
    "ad_running_totals": f"""
        select {_DAY}, userid, adid, clicks as "clickCount" from user_counts_all
        where (date, userid, adid) in (select (date, userid, adid) from clicks
                                       where hour(click_time) >= 12)""",
    "ad_blacklist": _BLACKLIST,
    "ad_region_counts": _REGIONS,
    "ad_province_counts":
        f'select {_DAY}, province, adid, n as "clickCount" from province_counts',
    "ad_province_top3": _PROVINCE_TOP,
    "ad_click_trend": _TREND,
    "ad_recent_hour": _RECENT_HOUR,
    "sink_overwrite": _CATEGORIES,
    "sink_append":
        f"{_ratio('task-1', 'kept')} union all {_ratio('task-2', 'kept_by_interest')}",
    "sink_upsert_add":
        f'select {_DAY}, userid, adid, clicks as "clickCount" from user_counts_all',
    "sink_levelled_totals":
        f'select {_DAY}, userid, adid, clicks as "clickCount" from user_counts_all',
    "sink_upsert_set": f"""
        select {_DAY}, province, city, adid, count(*) as "clickCount" from clicks
        group by clicks.date, province, city, adid""",
    "sink_replace_groups": f"""
        select {_DAY}, province, adid, n as "clickCount" from (
            select * from late_top union all
            select m.* from first_top m
            where not exists (select 1 from late_top l
                              where l.date = m.date and l.province = m.province))""",
    "sink_insert_new": _BLACKLIST,
    "table_overwrite": "select product_id, product_name, extend_info from product_info",
    "stream_ad_clicks_admitted": _ADMITTED,
    "stream_ad_blacklist": _BLACKLIST,
    "stream_ad_user_daily_clicks": _USER_CLICKS,
    "stream_ad_region_counts": _REGIONS,
    "stream_ad_province_top3": _PROVINCE_TOP,
    "stream_ad_click_trend": _TREND,
    "stream_ad_recent_hour": _RECENT_HOUR,
}


def _with_ctes(select: str) -> str:
    """The select, preceded by the table expressions it mentions, directly or indirectly."""
    needed, text = [], select
    for name, body in reversed(_CTES.items()):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, f"{name} as ({body})")
            text += body
    return "with " + ",\n".join(needed) + "\n" + select


def all_sql() -> dict[str, str]:
    return {name: _with_ctes(select) for name, select in _SELECTS.items()}
