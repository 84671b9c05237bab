"""Independent SQL for the registered queries, in the dialect of DuckDB."""

from __future__ import annotations

from martloom.bindings import AS_OF, CAMPAIGN_NOW, CITIES, DELIVERY_SHIFT, LOAD_DT, MENU_SIZE
from martloom.functions.keys import OID_NAMESPACE
from martloom.plans.couriers import PLACEHOLDER_PREFIX
from martloom.sources.events import CAPITAL_OF, ZONE_CITIES

K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
LOADED = f"timestamp '{LOAD_DT}' as load_dt"
S3 = f"{LOADED}, 's3' as load_src"


def _uuid(text: str) -> str:
    h = f"md5(unhex('{OID_NAMESPACE}') || encode({text}))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-'"
        f" || translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({h},18,3)"
        f" || '-' || substr({h},21,12))")


def _id(expr: str) -> str:
    return _uuid(f"cast({expr} as varchar)")


def _km(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"2 * 6371 * asin(sqrt(least(1.0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2))))")


# --- geo ------------------------------------------------------------------------

_NAMES = "[" + ", ".join(f"'{c}'" for c in CITIES) + "]"
_CAPITALS = " ".join(f"when '{a}' then '{b}'" for a, b in CAPITAL_OF.items())
_OWN = ", ".join(f"'{c}'" for c in ZONE_CITIES)
GEO = f"""
with named as (
  select n_nationkey as zone_id, coalesce({_NAMES}[n_nationkey + 1], n_name) as city,
    cast(cast(-12 - n_nationkey * 1.2 as decimal(9,2)) as double) as lat,
    cast(cast(114 + ((n_nationkey * 7) % 25) * 1.5 as decimal(9,2)) as double) as lng
  from nation),
zones as (
  select zone_id, city, lat, lng, 'Australia/' || case when city in ({_OWN}) then city
    else coalesce(case city {_CAPITALS} end, 'Sydney') end as timezone
  from named),
ev as (
  select *, {K} as k, event_type in ('view', 'click') as is_message,
    case when user_id % 3 = 0 then user_id % 25
      else (user_id + cast(floor(day(ts) / 10) as bigint)) % 25 end as z
  from events),
geo as (
  select event_id, ts, user_id, k, event_type, is_message, abs(user_id + k % 40 - 20) as message_to,
    case when is_message then cast(-12.0 as double) - z * cast(1.2 as double)
      + (event_id % 10) * cast(0.001 as double) end as lat,
    case when is_message then cast(114.0 as double) + ((z * 7) % 25) * cast(1.5 as double)
      + (event_id % 7) * cast(0.001 as double) end as lng
  from ev),
located as (
  select * from (
    select g.event_id, g.user_id, g.ts, zones.zone_id, zones.city, zones.timezone,
      {_km('g.lat', 'g.lng', 'zones.lat', 'zones.lng')} as km,
      row_number() over (partition by event_id
        order by {_km('g.lat', 'g.lng', 'zones.lat', 'zones.lng')}, zones.zone_id) as r
    from geo g, zones where g.is_message) where r = 1),
filled as (
  select event_id, user_id, ts, k, event_type, is_message,
    last_value(lat ignore nulls) over w as m_lat, last_value(lng ignore nulls) over w as m_lng
  from geo window w as (partition by user_id order by ts, event_id
    rows between unbounded preceding and current row)),
ranked as (
    select f.*, zones.zone_id, zones.city, {_km('f.m_lat', 'f.m_lng', 'zones.lat', 'zones.lng')} as km,
      row_number() over (partition by event_id
        order by {_km('f.m_lat', 'f.m_lng', 'zones.lat', 'zones.lng')}, zones.zone_id) as r
    from filled f, zones where f.m_lat is not null),
placed as (select * from ranked where r = 1),
marked as (
  select *, lag(city) over (partition by user_id order by ts, event_id) as before from located),
arrivals as (select user_id, event_id, city, ts from marked where before is null or before <> city),
stays as (
  select user_id, event_id, city, ts, next_ts,
    cast(date_diff('day', ts, coalesce(next_ts, (select max(ts) from located))) as int) as duration
  from (select *, lead(ts) over (partition by user_id order by ts, event_id) as next_ts from arrivals)),
qualified as (
  select *, max(duration) over (partition by user_id) as max_days,
    max(ts) over (partition by user_id, city) as latest from stays),
home as (
  select user_id, city as home_city from (
    select user_id, city, row_number() over (partition by user_id order by latest desc, city) as r
    from qualified where duration >= 27 or (max_days < 27 and duration = max_days)) where r = 1),
visits as (
  select user_id, row_number() over (partition by user_id order by ts, event_id) as visit_no, city, ts from stays),
act as (
  select user_id, city as act_city, timezone, ts from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as q from located) where q = 1),
first_event as (
  select user_id, ts, event_id, zone_id from (
    select *, row_number() over (partition by user_id order by ts, event_id) as q from placed) where q = 1),
tagged as (
  select p.*, f.event_id is not null as is_first from placed p left join first_event f on p.event_id = f.event_id),
weeks as (
  select zone_id, date_trunc('week', ts) as week,
    cast(count(*) filter (where is_message) as bigint) as week_message,
    cast(count(*) filter (where event_type in ('purchase', 'error')) as bigint) as week_reaction,
    cast(count(*) filter (where event_type = 'signup') as bigint) as week_subscription,
    cast(count(*) filter (where is_first) as bigint) as week_user
  from tagged group by all),
months as (
  select zone_id, date_trunc('month', ts) as month,
    cast(count(*) filter (where is_message) as bigint) as month_message,
    cast(count(*) filter (where event_type in ('purchase', 'error')) as bigint) as month_reaction,
    cast(count(*) filter (where event_type = 'signup') as bigint) as month_subscription,
    cast(count(*) filter (where is_first) as bigint) as month_user
  from tagged group by all),
members as (select distinct k as channel, user_id from geo where event_type = 'signup'),
contacts as (
  select distinct least(user_id, message_to) as user_1, greatest(user_id, message_to) as user_2
  from geo where is_message),
final as (
  select user_id, arg_max(lat, ts) filter (where lat is not null) as lat,
    arg_max(lng, ts) filter (where lat is not null) as lng, max(ts) as ts
  from geo group by user_id),
near as (
  select user_1, user_2, round(min(km), 6) as distance_km from (
    select a.user_id as user_1, b.user_id as user_2, {_km('pa.lat', 'pa.lng', 'pb.lat', 'pb.lng')} as km
    from members a join members b on a.channel = b.channel and a.user_id < b.user_id
    join final pa on pa.user_id = a.user_id join final pb on pb.user_id = b.user_id)
  where km <= 1.0 group by all),
uncontacted as (
  select user_1, user_2 from near where not exists (
    select 1 from contacts c where c.user_1 = near.user_1 and c.user_2 = near.user_2)),
user_zone as (
  select * from (
    select f.user_id, f.ts, zones.zone_id, zones.timezone, row_number() over (partition by f.user_id
      order by {_km('f.lat', 'f.lng', 'zones.lat', 'zones.lng')}, zones.zone_id) as r
    from final f, zones where f.lat is not null) where r = 1)
"""
_LOCAL = "timezone({tz}, timezone('UTC', {ts}))"


def _geo() -> dict[str, str]:
    q = {
        "geo_dimension": "select zone_id, city, lat, lng, timezone from zones",
        "scan_events": "select event_id, user_id as message_from, message_to, lat, lng as lon,"
                       " cast(ts as date) as date from geo where is_message",
        "geo_nearest_city": "select event_id, user_id, ts, zone_id, city, timezone,"
                            " round(km, 6) as distance_km from located",
        "geo_nearest_rank": "select event_id, zone_id, round(km, 6) as distance_km, cast(r as int) as rank"
                            " from ranked where r <= 3",
        "geo_nearest_grid": "select event_id, zone_id, city, round(km, 6) as distance_km from placed",
        "last_known_location": "select event_id, user_id, m_lat, m_lng from filled",
        "city_stays": "select * from stays",
        "home_city": "select * from home",
        "travel_history": "select * from visits",
        "actual_city": "select * from act",
        "user_geo_stats": "select home.user_id, act_city, home_city, travel_count, travel_array,"
                          f" {_LOCAL.format(tz='timezone', ts='ts')} as local_time"
                          " from home join act using (user_id) join (select user_id, count(*) as travel_count,"
                          " string_agg(city, ',' order by visit_no) as travel_array from visits group by user_id)"
                          " using (user_id)",
        "registrations": "select user_id, ts, event_id, zone_id from first_event",
        "zone_counts_week": "select * from weeks",
        "zone_counts_month": "select * from months",
        "zone_stats": "select coalesce(m.month, date_trunc('month', w.week)) as month, w.week,"
                      " coalesce(m.zone_id, w.zone_id) as zone_id, week_message, week_reaction, week_subscription,"
                      " week_user, month_message, month_reaction, month_subscription, month_user"
                      " from months m full join weeks w"
                      " on m.zone_id = w.zone_id and m.month = date_trunc('month', w.week)",
        "final_coordinates": "select * from final",
        "contact_pairs": "select * from contacts",
        "channel_members": "select * from members",
        "channel_pairs": "select * from near",
        "pairs_never_contacted": "select * from uncontacted",
        "friend_recommendations": "select user_1 as user_left, user_2 as user_right, zone_id,"
                                  f" timestamp '{LOAD_DT}' as processed_dttm,"
                                  f" {_LOCAL.format(tz='timezone', ts='ts')} as local_time"
                                  " from uncontacted join user_zone on user_1 = user_id",
    }
    return {name: GEO + sql for name, sql in q.items()}


# --- messenger --------------------------------------------------------------------

MESSENGER = f"""
with log as (
  select {K} % 20 as group_id, user_id, abs(user_id + event_id % 5 - 2) as inviter,
    case event_type when 'signup' then 'add' else 'leave' end as event, ts as event_dt
  from events where event_type in ('signup', 'error')),
cleaned as (
  select cast(group_id as bigint) as group_id, user_id,
    case when inviter <> user_id then inviter end as user_id_from, event, event_dt
  from (select *, lag(event) over (partition by user_id, group_id order by event_dt, event) as before from log)
  where before is null or before <> event),
grp as (
  select cast({K} % 20 as bigint) as id, min(user_id) as admin_id, min(ts) as registration_dt
  from events group by all),
usr as (
  select c_custkey as id, c_name as chat_name, timestamp '2020-01-01' + to_days(cast(c_custkey % 1000 as int))
    as registration_dt, n_name as country, cast(18 + c_custkey % 60 as int) as age
  from customer left join nation on c_nationkey = n_nationkey where c_acctbal >= 0),
dlg as (
  select event_id as message_id, ts as message_ts, user_id as message_from,
    abs(user_id + {K} % 40 - 20) as message_to, props as message,
    case when event_type = 'view' then cast({K} % 20 as bigint) end as message_group
  from events where event_type in ('view', 'click')),
hg as (select {_id('id')} as hk_group_id, id as group_id, registration_dt from grp),
hu as (select {_id('id')} as hk_user_id, id as user_id, registration_dt from usr),
hm as (select {_id('message_id')} as hk_message_id, message_id, message_ts from dlg),
lug as (
  select {_uuid('hk_group_id || hk_user_id')} as hk_l_user_group_activity, hk_group_id, hk_user_id
  from (select distinct group_id, user_id from cleaned) join hg using (group_id) join hu using (user_id)),
lum as (
  select {_uuid('hk_user_id || hk_message_id')} as hk_l_user_message, hk_user_id, hk_message_id
  from dlg join hu on message_from = user_id join hm using (message_id)),
lgm as (
  select {_uuid('hk_group_id || hk_message_id')} as hk_l_groups_dialogs, hk_group_id, hk_message_id
  from dlg join hg on message_group = group_id join hm using (message_id)),
la as (
  select {_uuid('hk_group_id || hk_user_id')} as hk_l_admin_id, hk_group_id, hk_user_id, hg.registration_dt
  from grp join hu on admin_id = user_id join hg on grp.id = hg.group_id),
sah as (
  select hk_l_user_group_activity, hk_group_id, hk_user_id, user_id_from, event, event_dt
  from cleaned join hg using (group_id) join hu using (user_id) join lug using (hk_group_id, hk_user_id)),
top as (select * from hg order by registration_dt, group_id limit 10),
added as (
  select hk_group_id, count(distinct hk_user_id) as cnt_added_users from sah where event = 'add' group by all),
active as (
  select hk_group_id, count(distinct hk_user_id) as cnt_users_in_group_with_messages
  from lgm join lum using (hk_message_id) group by all),
active_members as (
  select lgm.hk_group_id, count(distinct lum.hk_user_id) as cnt_users_in_group_with_messages
  from lgm join lum using (hk_message_id)
  where exists (select 1 from sah where event = 'add' and sah.hk_group_id = lgm.hk_group_id
    and sah.hk_user_id = lum.hk_user_id) group by all)
"""


def _messenger() -> dict[str, str]:
    conversion = (
        "select a.hk_group_id, cnt_added_users, cnt_users_in_group_with_messages,"
        " cnt_users_in_group_with_messages / cnt_added_users as group_conversion"
        " from added a left join {active} m on a.hk_group_id = m.hk_group_id"
        " where a.hk_group_id in (select hk_group_id from top)")
    q = {
        "event_changes": "select group_id, user_id, user_id_from, event, event_dt from cleaned",
        "vault_hub_users": f"select *, {S3} from hu",
        "vault_hub_messages": f"select hk_message_id, message_id, message_ts as datetime, {S3} from hm",
        "vault_hub_groups": f"select *, {S3} from hg",
        "vault_link_admins": f"select hk_l_admin_id, hk_group_id, hk_user_id, {S3} from la",
        "vault_link_user_message": f"select *, {S3} from lum",
        "vault_link_group_message": f"select *, {S3} from lgm",
        "vault_link_user_group": f"select *, {S3} from lug",
        "vault_sat_admins": "select hk_l_admin_id as hk_admin_id, true as is_admin,"
                            f" registration_dt as admin_from, {S3} from la",
        "vault_sat_dialog": f"select {_id('message_id')} as hk_message_id, message, message_from, message_to, {S3}"
                            " from dlg",
        "vault_sat_socdem": f"select {_id('id')} as hk_user_id, country, age, {S3} from usr",
        "vault_sat_chatinfo": f"select {_id('id')} as hk_user_id, chat_name, {S3} from usr",
        "vault_sat_group_name": f"select {_id('id')} as hk_group_id, 'group ' || id as group_name, {S3} from grp",
        "vault_sat_group_private": f"select {_id('id')} as hk_group_id, id % 4 = 0 as is_private, {S3} from grp",
        "vault_sat_auth_history": f"select hk_l_user_group_activity, user_id_from, event, event_dt, {S3} from sah",
        "vault_rerun_no_double": f"select *, {S3} from hu",
        "oldest_groups": f"select *, {S3} from top",
        "oldest_groups_semi": "select * from added where hk_group_id in (select hk_group_id from top)",
        "group_added_users": "select * from added",
        "group_active_users": "select * from active",
        "group_conversion": conversion.format(active="active"),
        "group_conversion_members": conversion.format(active="active_members"),
    }
    return {name: MESSENGER + sql for name, sql in q.items()}


# --- couriers and settlement ---------------------------------------------------------

COURIERS = f"""
with d as (
  select cast(l_orderkey as varchar) as order_id, o_orderdate as order_ts,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as delivery_id,
    cast(l_suppkey as varchar) as courier_id,
    'Street ' || (l_partkey % 50) || ', ' || (l_partkey % 200) || ', apt ' || l_linenumber as address,
    l_partkey % 50 as street_no, cast(l_partkey % 200 as int) as house, l_linenumber as apartment,
    l_shipdate + to_days({DELIVERY_SHIFT}) + interval 250 millisecond as delivery_ts,
    cast(case when l_suppkey % 6 = 0 then 3 + q % 3
      else 5 - case when q % (1 + l_suppkey % 6) = 0 then 1 else 0 end end as int) as rate,
    cast(l_extendedprice as decimal(12,2)) as order_sum,
    cast(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as decimal(12,2)) as tip_sum
  from (select *, cast(l_quantity as int) as q from lineitem) join orders on l_orderkey = o_orderkey),
c as (
  select courier_id, coalesce(s_name, '{PLACEHOLDER_PREFIX}' || courier_id) as name
  from (select courier_id from d union select cast(s_suppkey as varchar) from supplier where s_acctbal >= 0)
  left join supplier on courier_id = cast(s_suppkey as varchar) and s_acctbal >= 0),
m as (
  select courier_id, cast(year(order_ts) as int) as year, cast(month(order_ts) as int) as month,
    count(*) as orders_count, sum(order_sum) as total, sum(tip_sum) as tips, avg(rate) as rate,
    sum(greatest(cast(0.05 * order_sum as decimal(20,4)), cast(100 as decimal(20,4)))) as p1,
    sum(greatest(cast(0.07 * order_sum as decimal(20,4)), cast(150 as decimal(20,4)))) as p2,
    sum(greatest(cast(0.08 * order_sum as decimal(20,4)), cast(175 as decimal(20,4)))) as p3,
    sum(greatest(cast(0.10 * order_sum as decimal(20,4)), cast(200 as decimal(20,4)))) as p4
  from d group by all),
paid as (
  select *,
    case when rate < 4 then greatest(cast(0.05 * total as decimal(20,4)), cast(100 as decimal(20,4)))
      when rate < 4.5 then greatest(cast(0.07 * total as decimal(20,4)), cast(150 as decimal(20,4)))
      when rate < 4.9 then greatest(cast(0.08 * total as decimal(20,4)), cast(175 as decimal(20,4)))
      else greatest(cast(0.10 * total as decimal(20,4)), cast(200 as decimal(20,4))) end as by_month,
    cast(case when rate < 4 then p1 when rate < 4.5 then p2 when rate < 4.9 then p3 else p4 end
      as decimal(28,4)) as by_order
  from m)
"""


def _couriers() -> dict[str, str]:
    ledger = (
        "select courier_id, name as courier_name, year as settlement_year, month as settlement_month,"
        " orders_count, cast(total as double) as orders_total_sum, rate as rate_avg,"
        " cast(cast(total as decimal(24,2)) * cast(0.25 as decimal(4,2)) as double) as order_processing_fee,"
        " cast({paid} as double) as courier_order_sum, cast(tips as double) as courier_tips_sum,"
        " cast(cast({paid} as decimal(24,4)) + cast(tips as decimal(24,2)) * cast(0.95 as decimal(4,2)) as double)"
        " as courier_reward_sum from paid join c using (courier_id)")
    q = {
        "courier_ledger": ledger.format(paid="by_month"),
        "courier_ledger_order_floor": ledger.format(paid="by_order"),
        "courier_monthly": f"select {_id('courier_id')} as courier_id, year, month, orders_count,"
                           " cast(total as double) as orders_total_sum, cast(tips as double) as tip_sum, rate from m",
        "late_courier_members": f"select {_id('courier_id')} as id, courier_id, name from c"
                                f" where starts_with(name, '{PLACEHOLDER_PREFIX}')",
        "dim_couriers": f"select {_id('courier_id')} as id, courier_id, name from c",
        "dim_delivery_restaurants": f"select {_id('c_custkey')} as id, cast(c_custkey as varchar) as restaurant_id,"
                                    " c_name as name from customer",
        "dim_addresses": f"select distinct {_id('address')} as id, address as full_address, 'Moscow' as city,"
                         " 'Street ' || street_no as street, house as house_number, apartment from d",
        "dim_delivery_orders": f"select {_id('order_id')} as id, order_id, min(order_ts) as order_ts"
                               " from d group by order_id",
        "dim_deliveries": f"select {_id('delivery_id')} as id, delivery_id, {_id('courier_id')} as courier_id,"
                          f" {_id('address')} as address_id, delivery_ts, rate from"
                          " (select *, row_number() over (partition by delivery_id"
                          " order by delivery_ts, courier_id, address) as r from d) where r = 1",
        "fact_deliveries": f"select {_id('order_id')} as order_id, {_id('delivery_id')} as delivery_id,"
                           f" {_id('courier_id')} as courier_id, order_ts, rate,"
                           " cast(order_sum as double) as order_sum, cast(tip_sum as double) as tip_sum from d",
        "unmatched_keys": f"select 'courier_id' as key_name, {_id('courier_id')} as key_value from c"
                          f" where starts_with(name, '{PLACEHOLDER_PREFIX}')",
        "api_incremental_landing": "select distinct delivery_id,"
                                   " strftime(delivery_ts, '%Y-%m-%d %H:%M:%S') || '.250000' as delivery_ts from d",
    }
    return {name: COURIERS + sql for name, sql in q.items()}


STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
SETTLEMENT = f"""
with o as (
  select cast(o_orderkey as varchar) as order_key, o_orderkey, o_custkey, o_orderpriority as priority,
    case o_orderstatus when 'F' then 'CLOSED' when 'P' then 'CANCELLED' else 'OPEN' end as status,
    o_orderdate as ts, cast(o_totalprice as decimal(12,2)) as price
  from orders),
settled as (select * from o where status <> 'OPEN'),
items as (
  select o.*, i, cast(o_custkey * {MENU_SIZE} + (o_orderkey + i * 3) % {MENU_SIZE} as varchar) as product_key,
    priority in ('1-URGENT', '2-HIGH') as has_bonus
  from (select *, unnest(range(0, o_orderkey % 3 + 1)) as i from o where status = 'CLOSED') o),
fact as (
  select {_id('product_key')} as product_id, {_id('order_key')} as order_id,
    cast(case when has_bonus then 1 else 1 + (o_orderkey + i) % 5 end as int) as "count",
    cast(price + i as decimal(12,2)) as price,
    cast((price + i) * case when has_bonus then 1 else 1 + (o_orderkey + i) % 5 end as decimal(18,2)) as total_sum,
    case when has_bonus then 10 + i else 0 end as bonus_payment,
    case when has_bonus then o_orderkey % 7 else 0 end as bonus_grant,
    order_key, product_key, o_custkey, cast(ts as date) as day, ts as moment
  from items),
report as (
  select o_custkey, day, count(distinct order_key) as orders_count, sum(total_sum) as total,
    sum(bonus_payment) as bonus, sum(bonus_grant) as granted
  from fact where day < date '{AS_OF}' group by all)
"""


VERSION_KEY = (
    f"(c_custkey * {MENU_SIZE} + j) || '|' ||"
    " case when v = 1 then '2022-01-01 00:00:00' else '2022-02-01 00:00:00' end")


def _settlement() -> dict[str, str]:
    menu = (
        f" from (select *, unnest(range(0, {MENU_SIZE})) as j from customer)")
    q = {
        "dim_users": f"select {_id('c_custkey')} as id, cast(c_custkey as varchar) as user_id, c_name as user_name,"
                     " lower(c_mktsegment) || '_' || c_custkey as user_login from customer",
        "dim_restaurants": f"select {_id('c_custkey')} as id, cast(c_custkey as varchar) as restaurant_id,"
                           " c_name as restaurant_name, timestamp '2022-01-01' as active_from,"
                           " timestamp '2099-12-31' as active_to from customer",
        "dim_timestamps": f"select distinct {_uuid(STAMP)} as id, ts, cast(year(ts) as int) as year,"
                          " cast(month(ts) as int) as month, cast(day(ts) as int) as day,"
                          " strftime(ts, '%H:%M:%S') as time, cast(ts as date) as date from settled",
        "dim_products_scd2": f"select cast(c_custkey as varchar) as restaurant_id,"
                             f" cast(c_custkey * {MENU_SIZE} + j as varchar) as product_id,"
                             " 'dish ' || j as product_name,"
                             " cast(100 + c_custkey % 90 + case when v = 2 then 5 else 0 end as double) as product_price,"
                             " case when v = 1 then timestamp '2022-01-01' else timestamp '2022-02-01' end as active_from,"
                             " case when v = 1 and j % 2 = 0 then timestamp '2022-02-01'"
                             " else timestamp '2099-12-31' end as active_to,"
                             f" {_uuid(VERSION_KEY)} as id"
                             f" from (select *, unnest(range(1, 3)) as v {menu}) where v = 1 or j % 2 = 0",
        "dim_orders": f"select {_id('order_key')} as id, order_key, status as order_status,"
                      f" {_id('o_custkey')} as user_id, {_id('o_custkey')} as restaurant_id,"
                      f" {_uuid(STAMP)} as timestamp_id from settled",
        "fact_product_sales": 'select product_id, order_id, "count", cast(price as double) as price,'
                              " cast(total_sum as double) as total_sum, cast(bonus_payment as double) as bonus_payment,"
                              " cast(bonus_grant as double) as bonus_grant from fact",
        "fact_product_versions": 'select order_id, product_key, "count",'
                                 f" case when cast(product_key as bigint) % {MENU_SIZE} % 2 = 0"
                                 " and moment + interval 26 years >= timestamp '2022-02-01'"
                                 " then timestamp '2022-02-01' else timestamp '2022-01-01' end as active_from from fact",
        "settlement_report": "select cast(o_custkey as varchar) as restaurant_id, c_name as restaurant_name,"
                             " day as settlement_date, orders_count, cast(total as double) as orders_total_sum,"
                             " cast(bonus as double) as orders_bonus_payment_sum,"
                             " cast(granted as double) as orders_bonus_granted_sum,"
                             " cast(cast(total as decimal(24,2)) * cast(0.25 as decimal(4,2)) as double)"
                             " as order_processing_fee,"
                             " cast(cast(total as decimal(24,2)) * cast(0.75 as decimal(4,2))"
                             " - cast(bonus as decimal(24,2)) as double) as restaurant_reward_sum"
                             " from report join customer on o_custkey = c_custkey",
    }
    # However the documents come in, the history is that of the whole log.
    q["product_history_increments"] = q["dim_products_scd2"]
    return {name: SETTLEMENT + sql for name, sql in q.items()}


# --- order events -----------------------------------------------------------------------

ORDERS = f"""
with msg as (
  select l_orderkey * 8 + l_linenumber as object_id, o_orderdate as order_dt,
    l_shipdate + to_seconds(l_partkey % 86400) as sent_dttm,
    cast(l_extendedprice as decimal(12,2)) as cost, cast(o_custkey as varchar) as user_id, o_custkey,
    case o_orderstatus when 'F' then 'CLOSED' when 'P' then 'CANCELLED' else 'OPEN' end as status,
    l_partkey, l_quantity, cast(l_quantity as int) as quantity
  from lineitem join orders on l_orderkey = o_orderkey),
dishes as (
  select *, l_partkey as dish from msg
  union all
  select *, l_partkey // {MENU_SIZE} * {MENU_SIZE} + (l_partkey + 3) % {MENU_SIZE} from msg where l_quantity > 25),
lines as (
  select object_id as order_id, order_dt, cost, cost as payment, status, user_id, c_name as username,
    case when c_mktsegment = 'BUILDING' then 'login_was_not_loaded' else 'login_' || o_custkey end as userlogin,
    cast(dish // {MENU_SIZE} as varchar) as restaurant_id, 'kitchen ' || (dish // {MENU_SIZE}) as restaurant_name,
    cast(dish as varchar) as product_id, 'dish ' || dish as product_name,
    coalesce(p_type, 'unknown') as category_name, quantity,
    {_id('object_id')} as o, {_id('user_id')} as u, {_id('dish')} as p,
    {_id('dish // ' + str(MENU_SIZE))} as r, {_id("coalesce(p_type, 'unknown')")} as c
  from dishes join customer on o_custkey = c_custkey left join part on p_partkey = dish and p_size <= 45)
"""
KAFKA = f"{LOADED}, 'Kafka-stg-service-orders' as load_src"


def _orders() -> dict[str, str]:
    def linked(name: str, a: str, b: str) -> str:
        first, second = name.split("_")
        return (
            f"select distinct {_uuid(f'{a} || {b}')} as hk_{name}_pk, {a} as h_{first}_pk,"
            f" {b} as h_{second}_pk, {KAFKA} from lines")

    counter = (
        "select u as user_id, {k} as {n}_id, min({n}_name) as {n}_name, count(distinct o) as order_cnt"
        " from lines group by u, {k}")
    products = counter.format(k="p", n="product")
    categories = counter.format(k="c", n="category")
    q = {
        "order_enrichment": "select order_id, order_dt, cast(cost as double) as cost,"
                            " cast(payment as double) as payment, status, user_id, username, userlogin,"
                            " restaurant_id, restaurant_name, product_id, product_name, category_name, quantity"
                            " from lines",
        "vault2_h_user": f"select distinct u as h_user_pk, user_id, {KAFKA} from lines",
        "vault2_h_product": f"select distinct p as h_product_pk, product_id, {KAFKA} from lines",
        "vault2_h_category": f"select distinct c as h_category_pk, category_name, {KAFKA} from lines",
        "vault2_h_restaurant": f"select distinct r as h_restaurant_pk, restaurant_id, {KAFKA} from lines",
        "vault2_h_order": f"select o as h_order_pk, order_id, min(order_dt) as order_dt, {KAFKA}"
                          " from lines group by o, order_id",
        "vault2_l_order_product": linked("order_product", "o", "p"),
        "vault2_l_product_restaurant": linked("product_restaurant", "p", "r"),
        "vault2_l_product_category": linked("product_category", "p", "c"),
        "vault2_l_order_user": linked("order_user", "o", "u"),
        "vault2_s_order_cost": f"select distinct {_uuid("o || cast(cost as varchar) || '|' || cast(payment as varchar)")}"
                               " as hk_order_cost_pk, o as h_order_pk, cast(cost as double) as cost,"
                               f" cast(payment as double) as payment, {KAFKA} from lines",
        "vault2_s_order_status": f"select distinct {_uuid('o || status')} as hk_order_status_pk, o as h_order_pk,"
                                 f" status, {KAFKA} from lines",
        "vault2_s_product_names": f"select distinct {_uuid('p || product_name')} as hk_product_names_pk,"
                                  f" p as h_product_pk, product_name as name, {KAFKA} from lines",
        "vault2_s_restaurant_names": f"select distinct {_uuid('r || restaurant_name')} as hk_restaurant_names_pk,"
                                     f" r as h_restaurant_pk, restaurant_name as name, {KAFKA} from lines",
        "vault2_s_user_names": f"select distinct {_uuid("u || username || '|' || userlogin")} as hk_user_names_pk,"
                               f" u as h_user_pk, username, userlogin, {KAFKA} from lines",
        "user_product_counters": products,
        "user_category_counters": categories,
        "stream_user_product_counters": products,
        "stream_restart_no_double": categories,
        "order_chain_counters": products,
        "upsert_last_wins": "select object_id, sent_dttm, cast(cost as double) as cost, user_id from"
                            " (select *, row_number() over (partition by object_id"
                            " order by sent_dttm desc, cost desc, user_id desc) as r from msg) where r = 1",
    }
    return {name: ORDERS + sql for name, sql in q.items()}


# --- transactions and loads ---------------------------------------------------------------

METRICS = f"""
with t as (
  select cast(o_orderkey as varchar) as operation_id, o_custkey - 5 as account_number_from,
    o_custkey + 7 as account_number_to, c_nationkey as currency_code, 'country ' || c_nationkey as country,
    case o_orderstatus when 'F' then 'done' when 'P' then 'in_progress' else 'queued' end as status,
    'sbp_incoming' as transaction_type,
    cast(cast(o_totalprice as decimal(14,2)) * 100 as bigint) as amount,
    o_orderdate + to_seconds(o_orderkey % 86400) as transaction_dt,
    o_orderdate + to_days(1) as loaded
  from orders join customer on o_custkey = c_custkey),
rates as (
  select day, cast(code as int) as code, cast(1 + code * 0.01 as decimal(5,3)) as rate
  from (select day, unnest(range(1, 24)) as code from (select distinct o_orderdate as day from orders))),
agg as (
  select currency_code, cast(transaction_dt as date) as day, count(*) as cnt,
    count(distinct account_number_from) as accounts, sum(amount) as amount
  from t where status = 'done' and account_number_from > 0 group by all),
metrics as (
  select agg.day as date_update, currency_code as currency_from,
    cast(cast(amount as decimal(20,0)) * rate as double) as amount_total, cnt as cnt_transactions,
    cast(cast(round(cast(amount as decimal(26,6)) / accounts, 6) as decimal(26,6)) as double)
      as avg_transactions_per_account, accounts as cnt_accounts_make_transactions
  from agg join (select *, cast(day as date) as d from rates) r on code = currency_code and d = agg.day),
with_base as (
  select * from metrics union all
  select day, currency_code, cast(amount as double), cnt,
    cast(cast(round(cast(amount as decimal(26,6)) / accounts, 6) as decimal(26,6)) as double), accounts
  from agg where currency_code = 0)
"""
STG = f"{LOADED}, 'STG' as load_src"


def _metrics() -> dict[str, str]:
    fields = (
        "operation_id, account_number_from, account_number_to, currency_code, country, status,"
        " transaction_type, amount, transaction_dt")
    rate_rows = (
        "select day as date_update, code as currency_code, cast(0 as int) as currency_code_with,"
        " cast(rate as double) as currency_with_div, {lineage} from rates")
    q = {
        "daily_metrics": f"select *, {STG} from metrics",
        "daily_metrics_with_base": f"select *, {STG} from with_base",
        "merge_insert_only": "select *, case when date_update < date '1997-12-31' then timestamp '2024-01-01'"
                             f" else timestamp '{LOAD_DT}' end as load_dt, 'STG' as load_src from metrics",
        "incremental_files": f"select {fields}, {LOADED}, 'S3' as load_src from t",
        "daily_metrics_upsert": "select * from metrics",
        "load_with_lineage": rate_rows.format(lineage=f"{LOADED}, 'S3' as load_src"),
        "envelope_currencies": rate_rows.format(lineage=f"{LOADED}, 'Kafka-currency' as load_src"),
        "envelope_transactions": f"select {fields}, {LOADED}, 'Kafka-transaction' as load_src from t",
        "envelope_job_transactions": f"select {fields}, {LOADED}, 'Kafka-transaction' as load_src from t",
    }
    return {name: METRICS + sql for name, sql in q.items()}


def _loads() -> dict[str, str]:
    broken = f"{K} = 13"
    return {
        "mart_overwrite_roundtrip": "select user_id, count(*) as events from events group by user_id",
        "csv_load_good": f"select cast({K} % 20 as bigint) as group_id, user_id, user_id + event_id % 5 as user_id_from,"
                         f" event_type as event, date_trunc('second', ts) as event_dt from events where not ({broken})",
        "csv_load_rejects": f"select concat_ws(',', {K} % 20, 'u' || user_id, user_id + event_id % 5, event_type,"
                            f" strftime(ts, '%Y-%m-%d %H:%M:%S')) as rejected_line from events where {broken}",
        "jdbc_snapshot_copy": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier",
        "outbox_incremental": "select o_orderkey * 2 + copy + 1 as id, o_orderdate as event_ts,"
                              " case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'bonus_transaction'"
                              " else 'user_balance' end as event_type from (select *, unnest(range(0,"
                              " case when o_orderpriority = '1-URGENT' then 2 else 1 end)) as copy from orders)",
        "documents_incremental": "select cast(c_custkey as varchar) as object_id, timestamp '2022-02-01' as update_ts,"
                                 " cast(c_custkey * 10 + j as varchar) as product_id, 'dish ' || j as name,"
                                 " cast(100 + c_custkey % 90 + case when j % 2 = 0 then 5 else 0 end as double) as price"
                                 " from (select *, unnest(range(0, 10)) as j from customer)",
        "json_rejects": "select o_orderkey, parser, reason from (select o_orderkey, 'envelope' as parser, case o_orderkey % 7"
                        " when 2 then 'broken' when 3 then 'unknown type' when 4 then 'missing object_type' end as reason"
                        " from orders union all select o_orderkey, 'order', case o_orderkey % 7 when 5 then"
                        " 'missing object_id' when 6 then 'broken' end from orders) where reason is not null",
        "api_snapshot_landing": "select cast(s_suppkey as varchar) as courier_id, s_name as name,"
                                " count(*) over () as loaded_rows from supplier where s_acctbal >= 0",
        "daily_slices": "select event_id, ts, 'relational' as load_src, cast(ts as date) as load_day"
                        " from events where ts < timestamp '2024-01-30'",
        "insert_if_absent": "select o_custkey, coalesce(max(o_orderdate) filter (where o_orderdate < timestamp '1998-01-01'),"
                            " min(o_orderdate)) as first_order, case when min(o_orderdate) < timestamp '1998-01-01'"
                            " then 'target' else 'source' end as origin from orders group by o_custkey",
        "additive_upsert": "select o_custkey, o_orderstatus, count(*) as order_cnt from orders group by all",
        "load_state": "select 'stg' as layer, 'outbox' as source, 'events' as \"table\","
                      " cast(max(o_orderkey * 2 + 1 + case when o_orderpriority = '1-URGENT' then 1 else 0 end) as varchar)"
                      " as value, cast(1 as bigint) as run_id from orders union all"
                      " select 'dwh', 'stg', 'metrics', cast(cast(max(o_orderdate) as date) as varchar),"
                      " cast(2 as bigint) from orders",
    }


# --- campaigns -------------------------------------------------------------------------------

CAMPAIGNS = f"""
with c as (
  select k as restaurant, c as campaign, cast(k as varchar) as restaurant_id, cast(c as varchar) as adv_campaign_id,
    'content ' || c as adv_campaign_content, 'owner ' || k as adv_campaign_owner,
    'info' || k || '@example.org' as adv_campaign_owner_contact,
    cast({CAMPAIGN_NOW} + (k - 50) * 3600 as bigint) as adv_campaign_datetime_start,
    cast({CAMPAIGN_NOW} + (c - 10) * 3600 as bigint) as adv_campaign_datetime_end,
    cast({CAMPAIGN_NOW} - 86400 + c as bigint) as datetime_created
  from (select {K} as k, event_id % 50 as c from events where event_type = 'purchase')),
active as (
  select * from c where adv_campaign_datetime_start < {CAMPAIGN_NOW} and adv_campaign_datetime_end > {CAMPAIGN_NOW}),
subs as (
  select min(event_id) as id, cast(user_id as varchar) as client_id, cast({K} as varchar) as restaurant_id
  from events where event_type = 'view' group by user_id, {K}),
push as (
  select client_id, a.*, cast({CAMPAIGN_NOW} as bigint) as trigger_datetime_created
  from (select distinct * from active) a join subs using (restaurant_id))
"""


def _campaigns() -> dict[str, str]:
    body = (
        "restaurant_id, adv_campaign_id, adv_campaign_content, adv_campaign_owner, adv_campaign_owner_contact,"
        " adv_campaign_datetime_start, adv_campaign_datetime_end, datetime_created")
    q = {
        "static_subscribers": "select id, client_id, restaurant_id from subs",
        "campaign_active": "select restaurant_id, adv_campaign_id, adv_campaign_datetime_start,"
                           " adv_campaign_datetime_end from active",
        "stream_parse": f"select {body} from c",
        "stream_dedup": "select distinct restaurant_id, adv_campaign_id from c",
        "campaign_push": f"select client_id, {body}, trigger_datetime_created from push",
        "campaign_push_by_buckets": f"select client_id, {body}, trigger_datetime_created from push",
        "stream_fanout": "select 'topic' as sink, client_id, restaurant_id, adv_campaign_id, '' as feedback from push"
                         " union all select 'feedback', client_id, restaurant_id, adv_campaign_id, '' from push",
        "sink_json_value": "select '{\"restaurant_id\":\"' || restaurant_id || '\",\"adv_campaign_id\":\"'"
                           " || adv_campaign_id || '\",\"adv_campaign_datetime_start\":'"
                           " || adv_campaign_datetime_start || '}' as value from active",
        "sink_jdbc_feedback": f"select restaurant_id, adv_campaign_id, cast({CAMPAIGN_NOW} as bigint)"
                              " as trigger_datetime_created, '' as feedback from active",
    }
    return {name: CAMPAIGNS + sql for name, sql in q.items()}


def all_oracles() -> dict[str, str]:
    return {
        **_couriers(), **_settlement(), **_messenger(), **_geo(), **_orders(), **_metrics(), **_loads(),
        **_campaigns()}
