"""The same results in DuckDB SQL, written row by row over the plain tables."""

from __future__ import annotations

from beatgrid.plans.features import MODEL_INPUT

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


EV = """
ev as (
  select event_id as incident_id, cast(user_id % 21 as integer) as area, ts,
         date_trunc('hour', ts)::timestamp as hour_ts, cast(ts as date) as date,
         cast(hour(ts) as integer) as hour, event_type as category, value, props
  from events),
ev_pop as (
  select cast(user_id % 21 as integer) as area, count(distinct user_id) * 1000 as population
  from events group by 1)
"""

OI = """
oi as (
  select o_orderkey as incident_id, c_nationkey as area, cast(o_orderdate as date) as date,
         cast(o_orderkey % 24 as integer) as hour,
         cast(o_orderdate as timestamp) + to_hours(cast(o_orderkey % 24 as bigint)) as hour_ts,
         o_orderpriority as category, o_orderstatus as code, o_totalprice as price,
         c_acctbal as balance
  from orders join customer on o_custkey = c_custkey),
oi_pop as (
  select c_nationkey as area, cast(y as integer) as year,
         cast(count(*) * (1000 + 10 * (y - 1995)) as bigint) as population
  from customer, range(1995, 2003) t(y) group by 1, y)
"""

WEATHER = """
weather as (
  select s_nationkey as area, cast(l_shipdate as date) as date,
         (cast(sum(cast(l_quantity as bigint)) as bigint) * 10000 // count(*)) / 10000 as temp,
         (cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) * 100 // count(*)) / 10000 as wspeed
  from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2)
"""

RAW = """
raw as (
  select o_orderkey as dr_no,
         strftime(cast(o_orderdate as date) + 2, '%Y-%m-%d') as date_rptd,
         case when o_orderkey % 101 = 0 then 'n/a'
              when o_orderkey % 103 = 0 then null
              else strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') end as date_occ,
         cast((o_orderkey % 24) * 100 + o_orderkey % 60 as integer) as time_occ,
         c_nationkey as area, lower(n_name) as area_name,
         cast(o_orderkey % 2 + 1 as integer) as part_1_2,
         cast(o_orderkey % 9 * 100 as double) as crm_cd,
         lower(o_orderpriority) as crm_cd_desc,
         case when o_custkey % 7 <> 0 then o_orderpriority end as mocodes,
         cast(floor(c_acctbal / 80) as integer) as vict_age,
         case o_custkey % 6 when 0 then 'M' when 1 then 'F' when 2 then 'X' when 3 then 'H'
              when 4 then '-' end as vict_sex,
         case o_custkey % 7 when 0 then 'W' when 1 then 'B' when 2 then 'H' when 3 then 'A'
              when 4 then 'O' when 5 then 'K' end as vict_descent,
         case when o_custkey % 61 <> 0 then cast(o_custkey % 50 as double) end as premis_cd,
         nullif(c_mktsegment, 'BUILDING') as premis_desc,
         case when o_orderkey % 3 = 0 then cast(o_orderkey % 500 as double) end as weapon_used_cd,
         case when o_orderkey % 3 = 0 then 'tool' end as weapon_desc,
         case when o_orderkey % 97 <> 0 then lower(o_orderstatus) end as status,
         lower(o_orderstatus) as status_desc,
         o_totalprice as lat, c_acctbal as lon
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
"""

PARSED = "try_strptime({0}, ['%m/%d/%Y %I:%M:%S %p', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])::timestamp"

# hourly trail over incident rows, straight windows
EV_TRAIL = (
    EV
    + """,
ev_hour as (select area, hour_ts, count(*) as n from ev group by 1, 2),
ev_rate as (
  select ev.*, cast(n as double) / population * 1000 as hourly_rate
  from ev join ev_hour using (area, hour_ts) left join ev_pop using (area)),
ev_roll as (
  select *,
         case when count(hourly_rate) over w >= 12 then avg(hourly_rate) over w end as rolling_mean,
         case when count(hourly_rate) over w >= 12 then stddev_samp(hourly_rate) over w end as rolling_std,
         lag(hourly_rate) over o as rate_last_row,
         avg(hourly_rate) over (o rows between 3 preceding and 1 preceding) as rate_last_3_avg,
         sum(hourly_rate) over (o rows between 6 preceding and 1 preceding) as rate_last_6_sum
  from ev_rate
  window o as (partition by area order by hour_ts, incident_id),
         w as (partition by area order by hour_ts, incident_id rows between 23 preceding and current row)),
ev_z as (
  select *, case when rolling_std > 0 then (hourly_rate - rolling_mean) / rolling_std end as z_score
  from ev_roll),
ev_hot as (
  select *, cast(coalesce(round(z_score, 9) > 1.5, false) as integer) as is_hourly_hot from ev_z),
trail as (
  select *, lag(is_hourly_hot) over (partition by area order by hour_ts, incident_id) as was_hourly_hot_last_row
  from ev_hot)
"""
)


def with_(*parts: str) -> str:
    return "with " + ", ".join(p.strip() for p in parts) + " "


# ------------------------------------------------------------------ sources and sinks
ALL_EVENTS = "select event_id, ts, user_id, event_type, value, props from events"
oracle("io1_csv_scan", ALL_EVENTS)
oracle("io2_parquet_scan", "select event_id, ts, value from events where event_type = 'error' and value > 10")
oracle("io3_json_round_trip", ALL_EVENTS)
oracle("io4_parquet_sink", ALL_EVENTS)

EV_SPLIT = """
ranked as (
  select *, row_number() over (order by hour_ts, incident_id) as rn, count(*) over () as total from {src}),
halves as (
  select *, case when rn <= floor(total * 0.8) then 'train' else 'test' end as split from ranked)
"""
oracle("io5_split_sink", with_(EV, EV_SPLIT.format(src="ev")) + "select split, count(*) as n from halves group by 1")
oracle(
    "io6_split_metadata",
    with_(EV_TRAIL, EV_SPLIT.format(src="trail"))
    + """select split, is_hourly_hot, count(*) as n_rows, cast(3 as integer) as n_features,
         'area,hour_ts,incident_id' as feature_columns from halves group by 1, 2""",
)
oracle(
    "io7_run_versions",
    """select run_id, n_rows from (values ('run_20240101_000000_a'), ('run_20240102_000000_b')) r(run_id),
       (select count(*) as n_rows from events)""",
)
oracle("io8_district_attributes", "select n_nationkey as station, n_name as district, n_regionkey from nation")

# ------------------------------------------------------------------ cleaning
oracle("cl1_drop_columns", with_(RAW) + "select dr_no, area from raw")
FILLED = """
coalesce(cast(cast(weapon_used_cd as decimal(18,1)) as varchar), 'Weapon Usage Not Known') as weapon_used_cd,
coalesce(weapon_desc, 'Unknown') as weapon_desc, coalesce(vict_descent, 'X') as vict_descent,
coalesce(premis_desc, 'Unknown') as premis_desc
"""
oracle("cl2_fill_constants", with_(RAW) + f"select dr_no, {FILLED} from raw")
MODE = """
top_mocode as (
  select mocodes as m from raw where mocodes is not null group by 1 order by count(*) desc, 1 limit 1)
"""
oracle(
    "cl3_fill_mode",
    with_(RAW, MODE) + "select dr_no, coalesce(mocodes, m) as mocodes from raw, top_mocode",
)
oracle(
    "cl4_drop_invalid_code",
    with_(RAW) + "select dr_no, coalesce(vict_sex, 'X') as vict_sex from raw where coalesce(vict_sex, 'X') <> '-'",
)
oracle(
    "cl5_drop_nulls",
    with_(RAW) + "select dr_no, premis_cd, status from raw where premis_cd is not null and status is not null",
)
oracle(
    "cl6_parse_dates",
    with_(RAW)
    + f"select dr_no, {PARSED.format('date_occ')} as date_occ, {PARSED.format('date_rptd')} as date_rptd from raw",
)
oracle(
    "cl6b_parse_event_text",
    """select event_id, case when event_id % 7 <> 0 then date_trunc('second', ts)::timestamp end as ts_text
       from events""",
)
oracle(
    "cl7_repair_age",
    """select c_custkey, round(least(greatest(case when c_acctbal < 0
         then (select avg(c_acctbal) from customer where c_acctbal > 0) else c_acctbal end, 0), 5000), 6) as c_acctbal
       from customer""",
)
oracle(
    "cl8_allow_values",
    with_(RAW) + "select dr_no, case when vict_sex in ('M', 'F', 'X') then vict_sex else 'X' end as vict_sex from raw",
)
oracle("cl9_until_year", "select o_orderkey, o_orderdate from orders where year(o_orderdate) <= 1999")
oracle(
    "cl10_upper_case",
    with_(RAW)
    + """select dr_no, upper(area_name) as area_name, upper(crm_cd_desc) as crm_cd_desc,
         upper(status) as status, upper(status_desc) as status_desc from raw""",
)
oracle(
    "cl11_coerce_numbers",
    r"""select event_id, try_cast(case when event_id % 5 = 0 then props
          else regexp_extract(props, '(\d+)', 1) end as double) as reading from events""",
)
oracle("cl12_dedupe_rows", "select distinct l_suppkey, l_quantity, l_returnflag, l_linestatus from lineitem")
oracle(
    "cl13_keep_first",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
       qualify row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) = 1""",
)
oracle(
    "cl14_clean_reports",
    with_(
        RAW,
        MODE,
        f"""
filled as (
  select raw.* replace (
           coalesce(cast(cast(weapon_used_cd as decimal(18,1)) as varchar), 'Weapon Usage Not Known') as weapon_used_cd,
           coalesce(weapon_desc, 'Unknown') as weapon_desc, coalesce(vict_descent, 'X') as vict_descent,
           coalesce(premis_desc, 'Unknown') as premis_desc, coalesce(mocodes, m) as mocodes,
           coalesce(vict_sex, 'X') as vict_sex,
           {PARSED.format('date_occ')} as date_occ, {PARSED.format('date_rptd')} as date_rptd)
  from raw, top_mocode
  where coalesce(vict_sex, 'X') <> '-' and premis_cd is not null and status is not null),
mean_age as (select avg(vict_age) as m from filled where vict_age > 0)
""",
    )
    + """
select filled.* replace (
         round(least(greatest(case when vict_age < 0 then m else vict_age end, 0), 100), 6) as vict_age,
         case when vict_sex in ('M', 'F', 'X') then vict_sex else 'X' end as vict_sex,
         upper(area_name) as area_name, upper(crm_cd_desc) as crm_cd_desc,
         upper(status) as status, upper(status_desc) as status_desc,
         round(lat, 6) as lat, round(lon, 6) as lon)
from filled, mean_age where year(date_occ) <= 2000""",
)

# ------------------------------------------------------------------ sorts and top-k
oracle(
    "tk1_most_recent",
    with_(EV) + "select incident_id, area, ts, category from ev order by ts desc, incident_id desc limit 1000",
)
oracle("tk2_value_counts", with_(EV) + "select area, count(*) as n from ev group by 1 order by n desc, area limit 10")

CATEGORY_ROLL = """
cells as (select date, category, count(*) as n from oi group by 1, 2),
grid as (
  select d.date, c.category, n
  from (select distinct date from cells) d cross join (select distinct category from cells) c
  left join cells using (date, category)),
rolled as (
  select *, case when count(n) over w = {rows} then avg(n) over w end as rolling_mean from grid
  window w as (partition by category order by date rows between {back} preceding and current row))
"""
oracle(
    "tk3_leading_trends",
    with_(
        OI,
        CATEGORY_ROLL.format(rows=30, back=29),
        """
sums as (select category, coalesce(sum(rolling_mean), 0) as trend_sum from rolled group by 1),
placed as (
  select *, row_number() over (order by trend_sum desc, category) as ft,
         row_number() over (order by trend_sum, category desc) as fb from sums)
""",
    )
    + """select category, round(trend_sum, 4) as trend_sum, cast(ft as integer) as from_top,
         cast(fb as integer) as from_bottom, cast(ft <= 3 as integer) as is_top,
         cast(fb <= 4 as integer) as is_bottom from placed where ft <= 3 or fb <= 4""",
)
oracle("tk4_series_order", with_(EV) + "select incident_id, area, hour_ts, category from ev")

# ------------------------------------------------------------------ scalars
PARTS = """cast(year(date) as integer) as year, cast(month(date) as integer) as month,
cast(day(date) as integer) as day, cast(isodow(date) - 1 as integer) as day_of_week,
cast(quarter(date) as integer) as quarter"""
CYCLES = """round(sin(2 * pi() * hour / 24.0), 9) as hour_sin, round(cos(2 * pi() * hour / 24.0), 9) as hour_cos,
round(sin(2 * pi() * (isodow(date) - 1) / 7.0), 9) as day_of_week_sin,
round(cos(2 * pi() * (isodow(date) - 1) / 7.0), 9) as day_of_week_cos,
round(sin(2 * pi() * month(date) / 12.0), 9) as month_sin, round(cos(2 * pi() * month(date) / 12.0), 9) as month_cos"""
WEEK = """case when isodow(date) >= 5 then 'Weekend' else 'Weekday' end as weekend,
cast(isodow(date) >= 6 as integer) as is_weekend,
case when isodow(date) >= 6 then 'Weekend' else 'Weekday' end as week_type"""
KEYS = """concat(year(date), '_', month(date)) as year_month_key,
concat(cast(date as varchar), '_', hour) as date_hour_key"""

# the calendar as a generated table: the n-th weekday of a month is found by counting
HOLIDAYS = """
days as (
  select cast(d as date) as d, cast(year(d) as integer) as y, cast(month(d) as integer) as m,
         cast(day(d) as integer) as dom, cast(isodow(d) as integer) as dow
  from generate_series(date '1990-01-01', date '2030-12-31', interval 1 day) t(d)),
counted as (
  select *, row_number() over (partition by y, m, dow order by d) as nth,
         row_number() over (partition by y, m, dow order by d desc) as nth_last from days),
actual as (
  select d, dow from counted
  where (m = 1 and dom = 1) or (m = 6 and dom = 19 and y >= 2021) or (m = 7 and dom = 4)
     or (m = 11 and dom = 11) or (m = 12 and dom = 25)),
holidays as (
  select d from actual
  union select d + 1 from actual where dow = 7
  union select d - 1 from actual where dow = 6
  union select d from counted
  where (m = 1 and dow = 1 and nth = 3) or (m = 2 and dow = 1 and nth = 3)
     or (m = 5 and dow = 1 and nth_last = 1) or (m = 9 and dow = 1 and nth = 1)
     or (m = 10 and dow = 1 and nth = 2) or (m = 11 and dow = 4 and nth = 4))
"""
HOL = "(date in (select d from holidays))"

oracle("sc1_date_parts", with_(EV) + f"select incident_id, {PARTS} from ev")
oracle(
    "sc2_hour_of_hhmm",
    with_(EV)
    + """select incident_id, cast(hour(ts) * 100 + minute(ts) as integer) as hhmm,
         cast(hour(ts) as integer) as hour from ev""",
)
oracle(
    "sc3_hour_key",
    with_(EV)
    + "select incident_id, date, hour_ts, date::timestamp + to_hours(cast(hour as bigint)) as date_plus_hour from ev",
)
oracle("sc4_period_keys", with_(EV) + f"select incident_id, {KEYS} from ev")
oracle("sc5_cycles", with_(EV) + f"select incident_id, {CYCLES} from ev")
oracle("sc6_weekend_flags", with_(EV) + f"select incident_id, {WEEK} from ev")
oracle(
    "sc7_holiday_flag",
    with_(OI, HOLIDAYS)
    + f"""select incident_id, date, {HOL} as is_holiday,
          cast(date + interval 23 year as date) as later_date,
          cast(date + interval 23 year as date) in (select d from holidays) as later_is_holiday from oi""",
)
oracle(
    "sc8_weekend_or_holiday",
    with_(OI, HOLIDAYS) + f"select incident_id, isodow(date) >= 6 or {HOL} as is_weekend_or_holiday from oi",
)
oracle(
    "sc9_dictionary_map",
    with_(EV)
    + """select incident_id, category as offence, cast(incident_id % 3 as integer) as class_code,
         case when category in ('click', 'view') then 'USE' when category in ('purchase', 'signup') then 'SALE' end as category,
         case incident_id % 3 when 1 then 'Serious' when 2 then 'Less Serious' end as severity from ev""",
)
oracle(
    "sc10_code_groups",
    with_(RAW)
    + """select dr_no, vict_descent as code,
         case when vict_descent = 'W' then 'White' when vict_descent = 'B' then 'Black'
              when vict_descent = 'H' then 'Hispanic' when vict_descent in ('A', 'K') then 'Asian'
              else 'Other' end as descent from raw""",
)
oracle(
    "sc11_date_shift",
    with_(OI)
    + """select incident_id, date + 1 as next_day, date - 1 as prev_day,
         cast(date - interval 1 year as date) as last_year from oi""",
)
oracle(
    "sc12_label_bins",
    """select l_orderkey, l_linenumber, l_partkey,
         case when l_quantity * 2 <= 50 then 'Cold' when l_quantity * 2 <= 70 then 'Mild'
              when l_quantity * 2 <= 85 then 'Warm' else 'Hot' end as temp_category from lineitem""",
)
oracle(
    "sc13_night_value",
    with_(EV)
    + "select incident_id, value * case when hour >= 20 or hour <= 6 then 1 else 0 end as night_value from ev",
)
oracle(
    "sc14_high_flag",
    """select l_orderkey, l_linenumber, l_partkey, cast(l_extendedprice >
         (select quantile_cont(l_extendedprice, 0.75) from lineitem) as integer) as is_high from lineitem""",
)
TEMPORAL = f"{PARTS}, {CYCLES}, {WEEK}, {HOL} as is_holiday, isodow(date) >= 6 or {HOL} as is_weekend_or_holiday"
oracle(
    "sc15_temporal_features",
    with_(EV, HOLIDAYS) + f"select incident_id, date, hour, {TEMPORAL}, hour_ts, {KEYS} from ev",
)

# ------------------------------------------------------------------ aggregations
oracle(
    "ag1_hourly_rate",
    with_(EV)
    + """select area, date, hour, count(*) as n, round(cast(count(*) as double) / any_value(population) * 1000, 6) as hourly_rate
         from ev left join ev_pop using (area) group by 1, 2, 3""",
)
for _name, _grain, _keys in (
    ("ag2_daily_rate", "daily", "area, date"),
    ("ag3_monthly_rate", "monthly", "area, year, month"),
    ("ag4_yearly_rate", "yearly", "area, year"),
):
    oracle(
        _name,
        with_(OI, "parts as (select *, cast(year(date) as integer) as year, cast(month(date) as integer) as month from oi)")
        + f"""select {_keys}, count(*) as n,
              round(cast(count(*) as double) / any_value(population) * 1000, 6) as {_grain}_rate
              from parts left join oi_pop using (area, year) group by {_keys}""",
    )
oracle(
    "ag5_centroids",
    with_(OI)
    + """select incident_id, area, round(price, 4) as price, round(balance, 4) as balance,
         round(avg(price) over (partition by area), 4) as center_price,
         round(avg(balance) over (partition by area), 4) as center_balance from oi""",
)
OP = f"op as (select *, {PARTS} from oi)"
oracle(
    "ag6_counts_by_period",
    with_(OI, OP) + "select year, quarter, month, count(*) as n from op group by all",
)
oracle("ag6b_counts_by_date", with_(OI) + "select date, count(*) as n from oi group by 1")
for _name, _part in (("ag7_average_per_month", "month"), ("ag7b_average_per_quarter", "quarter")):
    oracle(
        _name,
        with_(OI, OP)
        + f"""select {_part}, count(*) as n,
              round(count(*) / (select count(distinct year) from op), 6) as avg_n from op group by 1""",
    )
oracle(
    "ag8_weekday_hour_pivot",
    with_(EV)
    + "select cast(isodow(date) - 1 as integer) as day_of_week, "
    + ", ".join(f"nullif(count(*) filter (hour = {h}), 0) as h{h}" for h in range(24))
    + " from ev group by 1",
)
CODES = ", ".join(f"count(*) filter (code = '{c}') as code_{c}" for c in "FOP")
oracle("ag9_cross_tab", with_(OI) + f"select category, {CODES} from oi group by 1")
oracle("ag10_year_by_code", with_(OI, OP) + f"select year, {CODES} from op group by 1")
FLAG = f"isodow(date) >= 6 or {HOL}"
SHARE = """select year, is_weekend_or_holiday, count(*) as n,
  round(count(*) / sum(count(*)) over (partition by year) * 100, 6) as pct from {0} group by 1, 2"""
oracle(
    "ag11_row_shares",
    with_(OI, HOLIDAYS, f"f as (select cast(year(date) as integer) as year, {FLAG} as is_weekend_or_holiday from oi)")
    + SHARE.format("f"),
)
oracle(
    "ag11b_calendar_shares",
    with_(
        OI,
        HOLIDAYS,
        f"f as (select cast(year(date) as integer) as year, {FLAG} as is_weekend_or_holiday from (select distinct date from oi))",
    )
    + SHARE.format("f"),
)
oracle(
    "ag12_describe",
    """select count(value) as n, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
         round(min(value), 6) as min, round(max(value), 6) as max,
         round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
         round(quantile_cont(value, 0.75), 6) as q75 from events""",
)
oracle(
    "ag13_table_summary",
    with_(RAW, f"p as (select raw.* replace ({PARSED.format('date_occ')} as date_occ) from raw)")
    + """select count(*) as n_rows, cast(23 as integer) as n_columns,
         count(*) filter (date_occ is null) as nulls_date_occ, count(*) filter (mocodes is null) as nulls_mocodes,
         count(*) filter (vict_sex is null) as nulls_vict_sex, count(*) filter (premis_cd is null) as nulls_premis_cd,
         count(*) filter (status is null) as nulls_status, count(*) filter (weapon_used_cd is null) as nulls_weapon_used_cd,
         min(date_occ) as first_date, max(date_occ) as last_date, count(distinct area_name) as n_areas from p""",
)
FIVE = ", ".join(
    f"round(quantile_cont(cast({{0}} as double), {p / 100}), 6) as p{p}" for p in (0, 25, 50, 75, 100)
)
oracle("ag14_five_numbers", with_(OI) + f"select category, {FIVE.format('price')} from oi group by 1")
DAILY = """daily as (
  select date, count(*) as n, case when isodow(date) >= 6 then 'Weekend' else 'Weekday' end as week_type
  from oi group by date)"""
oracle("ag14b_daily_counts_box", with_(OI, DAILY) + f"select week_type, {FIVE.format('n')} from daily group by 1")
oracle(
    "ag15_histogram",
    with_("b as (select min(value) as lo, max(value) as hi, (max(value) - min(value)) / 50 as w from events)")
    + """select cast(least(floor((value - lo) / w), 49) as integer) as bin,
         round(any_value(lo) + cast(least(floor((value - lo) / w), 49) as integer) * (any_value(hi) - any_value(lo)) / 50, 6) as bin_start,
         count(*) as n from events, b group by cast(least(floor((value - lo) / w), 49) as integer)""",
)
oracle(
    "ag16_headline",
    with_(
        EV,
        "a as (select area, count(*) as c from ev group by 1 order by 2 desc, 1 limit 1)",
        "k as (select category, count(*) as c from ev group by 1 order by 2 desc, 1 limit 1)",
    )
    + """select count(*) as n_rows, count(*) filter (isodow(date) >= 5) as n_weekend,
         round(count(*) filter (isodow(date) >= 5) / count(*) * 100, 6) as weekend_pct,
         any_value(a.area) as top_area, any_value(a.c) as top_area_n,
         any_value(k.category) as top_category, any_value(k.c) as top_category_n from ev, a, k""",
)
oracle(
    "ag17_class_balance",
    with_(EV_TRAIL, EV_SPLIT.format(src="trail"))
    + """select split, count(*) as n_rows, cast(sum(is_hourly_hot) as bigint) as n_positive,
         round(sum(is_hourly_hot) / count(*) * 100, 6) as positive_pct,
         min(hour_ts) as first_ts, max(hour_ts) as last_ts from halves group by 1""",
)

# ------------------------------------------------------------------ windows
for _name, _cols in (
    ("wn1_rolling_mean", "round(rolling_mean, 6) as rolling_mean"),
    ("wn2_rolling_std", "round(rolling_std, 6) as rolling_std"),
    ("wn3_z_score", "round(z_score, 6) as z_score"),
    ("wn4_hourly_hot", "round(hourly_rate, 6) as hourly_rate, is_hourly_hot"),
    ("wn8_lag_rate", "round(rate_last_row, 6) as rate_last_row"),
    ("wn9_mean_last_3", "round(rate_last_3_avg, 6) as rate_last_3_avg"),
    ("wn10_sum_last_6", "round(rate_last_6_sum, 6) as rate_last_6_sum"),
    ("wn11_lag_hot", "was_hourly_hot_last_row"),
):
    oracle(_name, with_(EV_TRAIL) + f"select incident_id, area, {_cols} from trail")


def _rated(src: str, pop: str, on: str) -> str:
    """Incident rows with the rates of the four grains."""
    out = []
    for grain, keys in (
        ("hourly", "area, hour_ts"),
        ("daily", "area, date"),
        ("monthly", "area, year, month"),
        ("yearly", "area, year"),
    ):
        out.append(
            f"cast(count(*) over (partition by {keys}) as double) / population * 1000 as {grain}_rate"
        )
    return f"""
{src}_parts as (select *, cast(year(date) as integer) as year, cast(month(date) as integer) as month from {src}),
{src}_rated as (select p.*, {', '.join(out)} from {src}_parts p left join {pop} using ({on}))
"""


OI_RATED = _rated("oi", "oi_pop", "area, year")
EV_RATED = _rated("ev", "ev_pop", "area")


def _hot_sql(grain: str, period: str) -> str:
    return (
        with_(
            OI,
            OI_RATED,
            f"cut as (select {period}, quantile_cont({grain}_rate, 0.75) as cut from oi_rated group by {period})",
        )
        + f"""select area, {period}, count(*) as n, round(any_value({grain}_rate), 6) as rate,
              round(any_value(cut), 6) as cut, cast(any_value({grain}_rate) > any_value(cut) as integer) as is_hot
              from oi_rated join cut using ({period}) group by area, {period}"""
    )


oracle("wn5_daily_hot", _hot_sql("daily", "date"))
oracle("wn6_monthly_hot", _hot_sql("monthly", "year, month"))
oracle("wn7_yearly_hot", _hot_sql("yearly", "year"))
oracle(
    "wn12_rolling_30_days",
    with_(OI, "daily as (select date, count(*) as n from oi group by 1)")
    + """select date, n, case when count(n) over w = 30 then round(avg(n) over w, 6) end as rolling_mean from daily
         window w as (order by date rows between 29 preceding and current row)""",
)
oracle(
    "wn13_rolling_by_category",
    with_(OI, CATEGORY_ROLL.format(rows=30, back=29))
    + "select date, category, n, round(rolling_mean, 6) as rolling_mean from rolled where n is not null",
)
AREA_SPLIT = """
ranked as (
  select *, row_number() over (partition by area order by hour_ts, incident_id) as rn,
         count(*) over (partition by area) as total from ev),
halves as (select *, case when rn <= floor(total * 0.8) then 'train' else 'test' end as split from ranked)
"""
oracle("wn14_split_per_area", with_(EV, AREA_SPLIT) + "select incident_id, area, hour_ts, split from halves")

# ------------------------------------------------------------------ joins
oracle(
    "jn1_rates_on_rows",
    with_(EV, EV_RATED)
    + "select incident_id, area, hour_ts, "
    + ", ".join(f"round({g}_rate, 6) as {g}_rate" for g in ("hourly", "daily", "monthly", "yearly"))
    + " from ev_rated",
)
oracle(
    "jn2_population_join",
    with_(OI)
    + """select incident_id, oi.area, cast(year(date) as integer) as year, population
         from oi left join oi_pop p on p.area = oi.area and p.year = year(oi.date)""",
)
oracle(
    "jn3_same_hour_yesterday",
    with_(EV_TRAIL)
    + """select i.incident_id, i.area, i.hour_ts, round(y.hourly_rate, 6) as rate_yesterday_same_hour
         from trail i left join (select distinct area, hour_ts, hourly_rate from trail) y
         on y.area = i.area and y.hour_ts = i.hour_ts - interval 1 day""",
)


def _day_flags(src: str) -> str:
    return f"""
{src}_cut as (select date, quantile_cont(daily_rate, 0.75) as cut from {src}_rated group by 1),
{src}_flag as (
  select distinct area, date, cast(daily_rate > cut as integer) as hot from {src}_rated join {src}_cut using (date))
"""


oracle(
    "jn4_hot_yesterday",
    with_(OI, OI_RATED, _day_flags("oi"))
    + """select incident_id, oi.area, oi.date, coalesce(f.hot, 0) as was_daily_hot_yesterday
         from oi left join oi_flag f on f.area = oi.area and f.date = oi.date - 1""",
)
oracle(
    "jn5_hot_last_year",
    with_(OI, OI_RATED, _day_flags("oi"))
    + """select incident_id, oi.area, oi.date, f.hot as was_hot_last_year
         from oi left join oi_flag f on f.area = oi.area and f.date = cast(oi.date - interval 1 year as date)""",
)
JOINED = """
joined as (select oi.*, w.temp as t0, w.wspeed as w0 from oi left join weather w using (area, date)),
med as (select median(t0) as mt, median(w0) as mw from joined)
"""
oracle(
    "jn6_weather_median_fill",
    with_(OI, WEATHER, JOINED)
    + """select incident_id, area, date, round(coalesce(t0, mt), 6) as temp, round(coalesce(w0, mw), 6) as wspeed
         from joined, med""",
)
oracle(
    "jn6b_weather_zero_fill",
    with_(OI, WEATHER, JOINED)
    + "select incident_id, area, date, round(coalesce(t0, 0), 6) as temp, round(coalesce(w0, 0), 6) as wspeed from joined",
)
oracle(
    "jn6c_weather_interactions",
    with_(
        OI,
        WEATHER,
        JOINED,
        "f as (select incident_id, area, date, hour, coalesce(t0, mt) as temp, coalesce(w0, mw) as wspeed from joined, med)",
    )
    + """select incident_id, area, date, hour, round(temp, 6) as temp, round(wspeed, 6) as wspeed,
         cast(wspeed > (select quantile_cont(wspeed, 0.75) from f) as integer) as high_wind,
         round(temp * case when hour >= 20 or hour <= 6 then 1 else 0 end, 6) as temp_night,
         case when temp <= 50 then 'Cold' when temp <= 70 then 'Mild' when temp <= 85 then 'Warm' else 'Hot' end as temp_category
         from f""",
)
oracle(
    "jn7_district_counts",
    with_(
        OI,
        "c as (select area, count(*) as n from oi group by 1)",
        "d as (select * from nation where n_nationkey <> 3)",
    )
    + """select d.*, c.area, c.n, 'left' as how from d left join c on n_nationkey = area
         union all select d.*, c.area, c.n, 'right' as how from d right join c on n_nationkey = area""",
)
oracle(
    "jn8_request_keys",
    with_(OI, "c as (select area, avg(price) as p, avg(balance) as b from oi group by 1)")
    + """select distinct oi.area, hour_ts, round(p, 4) as center_price, round(b, 4) as center_balance
         from oi join c using (area)""",
)
oracle(
    "jn9_top_area_per_category",
    "with recursive "
    + OI.strip()
    + """,
pairs as (
  select area, category, count(*) as n, row_number() over (order by count(*) desc, area, category) as rn
  from oi group by 1, 2),
pick as (
  select 0::bigint as rn, []::integer[] as areas, []::varchar[] as cats,
         null::integer as area, null::varchar as category, null::bigint as n, false as taken
  union all
  select p.rn,
         case when ok then list_append(areas, p.area) else areas end,
         case when ok then list_append(cats, p.category) else cats end,
         p.area, p.category, p.n, ok
  from (select k.*, q.area as pa, q.category as pc, q.n as pn, q.rn as prn,
               not list_contains(k.areas, q.area) and not list_contains(k.cats, q.category) as ok
        from pick k join pairs q on q.rn = k.rn + 1) s
  join pairs p on p.rn = s.prn)
select area, category, n from pick where taken""",
)

# ------------------------------------------------------------------ splits
oracle("st1_union_splits", ORACLE["wn14_split_per_area"])
oracle(
    "st2_time_split",
    with_(EV, EV_SPLIT.format(src="ev")) + "select incident_id, area, hour_ts, split from halves",
)
oracle(
    "st3_validation_split",
    with_(
        EV,
        EV_SPLIT.format(src="ev"),
        """again as (select *, row_number() over (order by hour_ts, incident_id) as rn2, count(*) over () as total2
             from halves where split = 'train')""",
    )
    + """select incident_id, area, hour_ts,
         case when rn2 <= floor(total2 * 0.8) then 'train' else 'validation' end as split from again""",
)


# ------------------------------------------------------------------ statistics
def _mw(src: str, value: str, first: str, where: str = "true") -> str:
    return f"""
s as (select cast({value} as double) as v, {first} as a from {src} where {where}),
r as (select *, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2 as rk from s),
t as (select sum(cast(c as double) * c * c - c) as tie from (select count(*) as c from s group by v)),
u as (
  select cast(count(*) filter (a) as bigint) as n1, cast(count(*) filter (not a) as bigint) as n2,
         sum(rk) filter (a) as r1 from r),
x as (
  select n1, n2, r1 - n1 * (n1 + 1) / 2 as u_stat,
         sqrt(cast(n1 as double) * n2 / 12 * ((n1 + n2 + 1) - tie / (cast(n1 + n2 as double) * (n1 + n2 - 1)))) as sigma
  from u, t),
y as (
  select *, (greatest(u_stat, cast(n1 as double) * n2 - u_stat) - cast(n1 as double) * n2 / 2 - 0.5) / sigma as z from x)
"""


# normal tail by its power series / integration: sum of z^(2k+1) / (1*3*5..) times the density
TAIL = """
2 * (0.5 - exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120),
  lambda k: exp((2 * k + 1) * ln(greatest(z, 1e-300)) - list_sum(list_transform(range(0, k + 1), lambda j: ln(2 * j + 1.0)))))))
"""
MW_OUT = f"""select n1, n2, round(u_stat, 4) as u_stat, round(z, 4) as z, round({TAIL}, 4) as p_value,
  {TAIL} < 0.05 as significant from y"""
oracle("sa1_mann_whitney", with_(OI, DAILY, _mw("daily", "n", "week_type = 'Weekday'")) + MW_OUT)
oracle("sa1b_mann_whitney_rows", with_(OI, _mw("oi", "price", "code = 'F'", "code in ('F', 'O')")) + MW_OUT)
oracle(
    "sa1c_mann_whitney_code_frequency",
    with_(
        RAW,
        f"""d as (select crm_cd, cast({PARSED.format('date_occ')} as date) as date from raw),
            f as (select crm_cd, isodow(date) >= 5 as weekend, count(*) as n from d where date is not null group by 1, 2)""",
        _mw("f", "n", "weekend"),
    )
    + MW_OUT,
)
CHI = """
cells as (select r, c, cast(count(*) as double) as o from s group by 1, 2),
grid as (
  select coalesce(o, 0) as o, rt * ct / n as e from (select r, sum(o) as rt from cells group by 1)
  cross join (select c, sum(o) as ct from cells group by 1) cross join (select sum(o) as n from cells)
  left join cells using (r, c)),
dims as (select (count(distinct r) - 1) * (count(distinct c) - 1) as dof from cells),
stat as (
  select sum(power(abs(o - e) - case when dof = 1 then least(0.5, abs(o - e)) else 0 end, 2) / e) as chi2,
         any_value(dof) as dof, cast(sum(o) as bigint) as n from grid, dims)
"""
# dof 8: finite sum; dof 1: normal tail at sqrt(chi2)
oracle(
    "sa2_chi_square",
    with_(OI, "s as (select category as r, code as c from oi)", CHI)
    + """select n, round(chi2, 6) as chi2, dof,
         round(exp(-chi2 / 2) * (1 + chi2 / 2 + power(chi2 / 2, 2) / 2 + power(chi2 / 2, 3) / 6), 6) as p_value,
         exp(-chi2 / 2) * (1 + chi2 / 2 + power(chi2 / 2, 2) / 2 + power(chi2 / 2, 3) / 6) < 0.05 as significant from stat""",
)
oracle(
    "sa2b_chi_square_2x2",
    with_(
        OI,
        "s as (select price > 200000 as r, balance > 0 as c from oi)",
        CHI,
        "y as (select *, sqrt(chi2) as z from stat)",
    )
    + f"select n, round(chi2, 6) as chi2, dof, round({TAIL}, 6) as p_value, {TAIL} < 0.05 as significant from y",
)
oracle(
    "sa3_normality",
    with_(
        OI,
        DAILY,
        """m as (select week_type, count(*) as n, avg(n) as mu from daily group by 1),
           p as (select week_type, any_value(m.n) as n, avg(power(d.n - mu, 2)) as m2, avg(power(d.n - mu, 3)) as m3,
                        avg(power(d.n - mu, 4)) as m4 from daily d join m using (week_type) group by 1),
           k as (select week_type, n, m3 / power(m2, 1.5) as s, m4 / (m2 * m2) - 3 as k from p)""",
    )
    + """select week_type, n, round(s, 5) as skewness, round(k, 5) as excess_kurtosis,
         round(n / 6 * (s * s + k * k / 4), 5) as jb, round(exp(-n / 6 * (s * s + k * k / 4) / 2), 5) as p_value from k""",
)

# ------------------------------------------------------------------ feature table
EV_FEATURES = with_(
    EV_TRAIL,
    HOLIDAYS,
    EV_RATED,
    _day_flags("ev"),
    """
ev_mcut as (select year, month, quantile_cont(monthly_rate, 0.75) as mcut from ev_rated group by 1, 2),
ev_ycut as (select year, quantile_cont(yearly_rate, 0.75) as ycut from ev_rated group by 1),
cells as (select distinct area, hour_ts, hourly_rate from trail),
feat as (
  select t.*, r.daily_rate, r.monthly_rate, r.yearly_rate, f.hot as is_daily_hot,
         cast(coalesce(r.monthly_rate > mcut, false) as integer) as is_monthly_hot,
         cast(coalesce(r.yearly_rate > ycut, false) as integer) as is_yearly_hot,
         coalesce(fy.hot, 0) as was_daily_hot_yesterday, fl.hot as was_hot_last_year,
         c.hourly_rate as rate_yesterday_same_hour
  from trail t join ev_rated r using (incident_id)
  left join ev_flag f on f.area = t.area and f.date = t.date
  left join ev_flag fy on fy.area = t.area and fy.date = t.date - 1
  left join ev_flag fl on fl.area = t.area and fl.date = cast(t.date - interval 1 year as date)
  left join ev_mcut m on m.year = r.year and m.month = r.month
  left join ev_ycut y on y.year = r.year
  left join cells c on c.area = t.area and c.hour_ts = t.hour_ts - interval 1 day)
""",
)
NUMBERS = [
    "hourly_rate", "daily_rate", "monthly_rate", "yearly_rate", "rolling_mean", "rolling_std",
    "z_score", "rate_last_row", "rate_last_3_avg", "rate_last_6_sum", "rate_yesterday_same_hour",
]
FLAGS = [
    "is_hourly_hot", "was_hourly_hot_last_row", "is_daily_hot", "is_monthly_hot", "is_yearly_hot",
    "was_daily_hot_yesterday", "was_hot_last_year",
]
CYC6 = CYCLES.replace(", 9)", ", 6)")
TEMPORAL6 = TEMPORAL.replace(CYCLES, CYC6)
oracle(
    "ds1_features",
    EV_FEATURES
    + f"""select incident_id, area, date, hour, category, {TEMPORAL6}, hour_ts, {KEYS},
          {', '.join(f'round({n}, 6) as {n}' for n in NUMBERS)}, {', '.join(FLAGS)} from feat""",
)
CYCLE_COLS = {
    "hour_sin": "sin(2 * pi() * hour / 24.0)",
    "hour_cos": "cos(2 * pi() * hour / 24.0)",
    "dayofweek_sin": "sin(2 * pi() * (isodow(date) - 1) / 7.0)",
    "dayofweek_cos": "cos(2 * pi() * (isodow(date) - 1) / 7.0)",
    "month_sin": "sin(2 * pi() * month(date) / 12.0)",
    "month_cos": "cos(2 * pi() * month(date) / 12.0)",
}
MODEL_SQL = {
    "datetime_key": "hour_ts",
    **CYCLE_COLS,
    "year": "cast(year(date) as integer)",
    "isholiday": HOL,
    "isweekendorholiday": f"isodow(date) >= 6 or {HOL}",
    "weekend": "case when isodow(date) >= 5 then 'Weekend' else 'Weekday' end",
    "area_name": "area",
    "hourly_crime_rate_per_1000": "coalesce(hourly_rate, 0)",
    "daily_crime_rate_per_1000": "coalesce(daily_rate, 0)",
    "monthly_crime_rate_per_1000": "coalesce(monthly_rate, 0)",
    "yearly_crime_rate_per_1000": "coalesce(yearly_rate, 0)",
    "crime_rate_last_1h": "coalesce(rate_last_row, 0)",
    "crime_rate_last_3h_avg": "coalesce(rate_last_3_avg, 0)",
    "crime_rate_last_6h_sum": "coalesce(rate_last_6_sum, 0)",
    "crime_rate_yesterday_same_hour": "coalesce(rate_yesterday_same_hour, 0)",
    "was_hourly_hotspot_last_hour": "coalesce(was_hourly_hot_last_row, 0)",
    "was_daily_hotspot_yesterday": "coalesce(was_daily_hot_yesterday, 0)",
    "was_hotspot_last_year_same_day": "coalesce(was_hot_last_year, 0)",
    "is_hourly_hotspot": "is_hourly_hot",
}
DROPPED = ("yearly_crime_rate_per_1000", "crime_rate_last_3h_avg", "crime_rate_last_6h_sum", "month_cos")
DOUBLES = set(CYCLE_COLS) | {c for c in MODEL_SQL if c.endswith("_1000") or c.startswith("crime_rate")}


def _model(columns: dict[str, str], drop: tuple[str, ...] = DROPPED) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items() if c not in drop)


def _round(columns, drop: tuple[str, ...] = DROPPED, extra: tuple[str, ...] = ()) -> str:
    return ", ".join(
        f"round({c}, 6) as {c}" if c in DOUBLES or c in extra else c for c in columns if c not in drop
    )


oracle(
    "sa5_drop_correlated",
    EV_FEATURES
    + f", m as (select incident_id, {_model(MODEL_SQL)} from feat) select incident_id, {_round(MODEL_SQL)} from m",
)
oracle(
    "ds2_model_table",
    EV_FEATURES
    + f", m as (select distinct {_model(MODEL_SQL)} from feat) select {_round(MODEL_SQL)} from m",
)
oracle("ds2b_model_table_from_cells", ORACLE["ds2_model_table"])
_NOT_FEATURES = ("datetime_key", "isholiday", "isweekendorholiday", "weekend", "area_name", "hourly_crime_rate_per_1000", "is_hourly_hotspot")
_FEATURES = [c for c in MODEL_SQL if c not in DROPPED and c not in _NOT_FEATURES]
oracle(
    "st5_features_target",
    EV_FEATURES
    + f""", m as (select min(incident_id) as incident_id, {_model(MODEL_SQL)} from feat group by all)
          select incident_id, {_round(_FEATURES)}, is_hourly_hotspot from m""",
)
_CORR = {
    "hour_sin": CYCLE_COLS["hour_sin"], "hour_cos": CYCLE_COLS["hour_cos"],
    "day_of_week_sin": CYCLE_COLS["dayofweek_sin"], "day_of_week_cos": CYCLE_COLS["dayofweek_cos"],
}
_CORR_COLS = [
    "hourly_rate", "daily_rate", "monthly_rate", "yearly_rate", "rate_last_row",
    "rate_last_3_avg", "rate_last_6_sum", "rate_yesterday_same_hour",
    "was_hourly_hot_last_row", "was_daily_hot_yesterday", "hour_sin", "hour_cos",
    "day_of_week_sin", "day_of_week_cos", "is_hourly_hot",
]
oracle(
    "sa4_correlations",
    EV_FEATURES
    + ", c as (select "
    + ", ".join(f"{_CORR.get(c, c)} as {c}" for c in _CORR_COLS)
    + " from feat), k as (select * from c where "
    + " and ".join(f"{c} is not null" for c in _CORR_COLS)
    + ") "
    + " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as r from k"
        for i, a in enumerate(_CORR_COLS)
        for b in _CORR_COLS[i:]
    ),
)

OI_TRAIL = """
oi_roll as (
  select *,
         case when count(hourly_rate) over w >= 12 then avg(hourly_rate) over w end as rolling_mean,
         case when count(hourly_rate) over w >= 12 then stddev_samp(hourly_rate) over w end as rolling_std,
         lag(hourly_rate) over o as rate_last_row,
         avg(hourly_rate) over (o rows between 3 preceding and 1 preceding) as rate_last_3_avg,
         sum(hourly_rate) over (o rows between 6 preceding and 1 preceding) as rate_last_6_sum
  from oi_rated
  window o as (partition by area order by hour_ts, incident_id),
         w as (partition by area order by hour_ts, incident_id rows between 23 preceding and current row)),
oi_hot as (
  select *, cast(coalesce(round(case when rolling_std > 0 then (hourly_rate - rolling_mean) / rolling_std end, 9) > 1.5, false) as integer) as is_hourly_hot
  from oi_roll),
oi_cells as (select distinct area, hour_ts, hourly_rate as yr from oi_rated),
feat as (
  select t.*, lag(is_hourly_hot) over (partition by t.area order by t.hour_ts, incident_id) as was_hourly_hot_last_row,
         coalesce(fy.hot, 0) as was_daily_hot_yesterday, fl.hot as was_hot_last_year,
         c.yr as rate_yesterday_same_hour, coalesce(t0, mt) as temp, coalesce(w0, mw) as wspeed
  from oi_hot t cross join med
  join (select incident_id, t0, w0 from joined) j using (incident_id)
  left join oi_flag fy on fy.area = t.area and fy.date = t.date - 1
  left join oi_flag fl on fl.area = t.area and fl.date = cast(t.date - interval 1 year as date)
  left join oi_cells c on c.area = t.area and c.hour_ts = t.hour_ts - interval 1 day)
"""
WEATHER_SQL = {**MODEL_SQL, "temp": "temp", "wspeed": "wspeed"}
oracle(
    "ds1b_features_with_weather",
    with_(OI, OI_RATED, _day_flags("oi"), WEATHER, JOINED, HOLIDAYS, OI_TRAIL)
    + f""", m as (select incident_id, {_model(WEATHER_SQL, ())} from feat)
          select incident_id, {_round(WEATHER_SQL, (), ('temp', 'wspeed'))} from m""",
)

# ------------------------------------------------------------------ evaluation
RULES = """
rules as (
  select incident_id, is_hourly_hot as label, 'last_hour' as model,
         round(least(coalesce(round(rate_last_row, 9), 0) * 4, 1.0), 6) as score from trail
  union all
  select incident_id, is_hourly_hot, 'same_hour', round(least(round(hourly_rate, 9) * 3, 1.0), 6) from trail
  union all
  select incident_id, is_hourly_hot, 'never', 0.0 from trail),
scored as (select *, cast(score > 0.5 as integer) as prediction from rules),
one as (select * from scored where model = 'same_hour')
"""
COUNTS = """count(*) filter (label = 1 and prediction = 1) as tp, count(*) filter (label = 0 and prediction = 1) as fp,
count(*) filter (label = 1 and prediction = 0) as fn, count(*) filter (label = 0 and prediction = 0) as tn"""
METRICS = """round(coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0), 6) as accuracy,
round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall,
round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1_score"""
SCORED = with_(EV_TRAIL, RULES)
oracle(
    "ev1_confusion_matrix",
    SCORED
    + """select cast(l as integer) as label, cast(p as integer) as prediction, count(incident_id) as n
         from range(0, 2) a(l) cross join range(0, 2) b(p)
         left join one on label = l and prediction = p group by 1, 2""",
)
oracle("ev2_metrics", SCORED + f", k as (select {COUNTS} from one) select {METRICS} from k")
oracle(
    "ev3_class_report",
    SCORED
    + f""", k as (select {COUNTS} from one),
per as (
  select '0' as class, tn / nullif(tn + fn, 0) as p, tn / nullif(tn + fp, 0) as r, 2 * tn / nullif(2 * tn + fn + fp, 0) as f, tn + fp as s from k
  union all
  select '1', tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0), 2 * tp / nullif(2 * tp + fp + fn, 0), tp + fn from k),
every as (
  select class, coalesce(p, 0) as p, coalesce(r, 0) as r, coalesce(f, 0) as f, s from per
  union all select 'accuracy', (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn from k
  union all select 'macro avg', avg(coalesce(p, 0)), avg(coalesce(r, 0)), avg(coalesce(f, 0)), sum(s) from per
  union all select 'weighted avg', sum(coalesce(p, 0) * s) / sum(s), sum(coalesce(r, 0) * s) / sum(s), sum(coalesce(f, 0) * s) / sum(s), sum(s) from per)
select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score, cast(s as bigint) as support from every""",
)
AUC = """select {by} count(*) filter (label = 1) as n_pos, count(*) filter (label = 0) as n_neg,
  round((sum(rk) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2)
    / (count(*) filter (label = 1) * count(*) filter (label = 0)), 6) as roc_auc
from (select *, rank() over (partition by model order by score) + (count(*) over (partition by model, score) - 1) / 2 as rk from {src})
{group}"""
oracle("ev4_roc_auc", SCORED + AUC.format(by="", src="one", group=""))
oracle(
    "ev7_compare_models",
    SCORED
    + f""", k as (select model, {COUNTS} from scored group by 1),
a as ({AUC.format(by='model,', src='scored', group='group by model')})
select model, {METRICS}, roc_auc from k join a using (model)""",
)
oracle(
    "ev8_quality_gate",
    SCORED
    + f""", k as (select model, {COUNTS} from scored group by 1), q as (select model, {METRICS} from k)
select model, f1_score, f1_score >= 0.7 as approved, case when f1_score < 0.6 then 'High' else 'Low' end as risk from q""",
)
oracle(
    "ev9_threshold_sweep",
    SCORED
    + f""", th as (select t / 10.0::double as threshold from range(1, 10) r(t)),
p as (select threshold, label, cast(score >= threshold as integer) as prediction from one, th),
k as (select threshold, {COUNTS} from p group by 1)
select round(threshold, 6) as threshold, tp, fp, fn, tn, {METRICS} from k""",
)
oracle(
    "ev10_evaluation_report",
    SCORED
    + f""", k as (select {COUNTS} from one)
select 'same_hour' as model_type, {METRICS}, tp + fp + fn + tn as test_size,
  round((tp + fn) / (tp + fp + fn + tn), 6) as positive_class_ratio, cast(2 as integer) as feature_count from k""",
)
oracle(
    "ml10_voting",
    with_(EV_TRAIL)
    + """, w as (
  select incident_id, least(coalesce(round(rate_last_row * 4, 6), 0), 1) as m1, least(round(hourly_rate * 3, 6), 1) as m2,
         cast(coalesce(was_hourly_hot_last_row, 0) as double) as m3 from trail),
v as (
  select incident_id, (m1 * 1.0 + m2 * 2.0 + m3 * 1.0) / 4.0 as s,
         ((m1 > 0.5)::integer + (m2 > 0.5)::integer * 2 + (m3 > 0.5)::integer) / 4.0 as h from w)
select incident_id, round(s, 6) as soft_score, cast(s > 0.5 as integer) as soft_vote, cast(h > 0.5 as integer) as hard_vote from v""",
)

# ------------------------------------------------------------------ preparation
_IMPUTED = ["rate_last_row", "rate_last_3_avg", "rate_yesterday_same_hour", "z_score"]
oracle(
    "ds3_mean_imputer",
    EV_FEATURES
    + "select incident_id, "
    + ", ".join(f"round(coalesce({c}, avg({c}) over ()), 6) as {c}" for c in _IMPUTED)
    + " from feat",
)
_SCALED = ["hourly_rate", "daily_rate", "rate_last_6_sum", "hour_sin"]
oracle(
    "ds4_min_max_scaling",
    EV_FEATURES
    + f""", s as (select incident_id, hourly_rate, daily_rate,
              coalesce(rate_last_6_sum, avg(rate_last_6_sum) over ()) as rate_last_6_sum,
              {CYCLE_COLS['hour_sin']} as hour_sin from feat)
          select incident_id, """
    + ", ".join(
        f"round(({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()), 6) as {c}" for c in _SCALED
    )
    + " from s",
)
oracle(
    "ml12b_error_threshold",
    with_(EV_TRAIL)
    + """select incident_id, is_hourly_hot as label, round(value, 6) as recon_error,
         cast(value > (select quantile_cont(value, 0.8) from trail where is_hourly_hot = 0) as integer) as is_anomaly
         from trail""",
)

# ------------------------------------------------------------------ what a fit does not decide
oracle(
    "st4b_stratified_sizes",
    with_(EV_TRAIL)
    + """, c as (select is_hourly_hot, count(*) as n from trail group by 1)
    select is_hourly_hot, 'train' as split, n - cast(ceil(n * 0.2) as bigint) as n from c where n - ceil(n * 0.2) > 0
    union all select is_hourly_hot, 'test', cast(ceil(n * 0.2) as bigint) from c where n > 0""",
)
def drawn(*parts: str, digits: int = 15) -> str:
    """The number that a hash of the parts begins with."""
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, {digits}))::bigint"


oracle(
    "st4_stratified_split",
    with_(EV_TRAIL)
    + f"""select incident_id, is_hourly_hot,
         case when row_number() over (partition by is_hourly_hot order by {drawn("incident_id", "42")}) <= count(*) over c - ceil(count(*) over c * 0.2)
              then 'train' else 'test' end as split
       from trail window c as (partition by is_hourly_hot)""",
)
# the model rows with weather by area and hour, and their time split
_LEARN_SQL = {**MODEL_SQL, "temp": "temp", "wspeed": "wspeed"}
LEARN = (
    EV_FEATURES
    + f""", reading as (
      select cast(user_id % 21 as integer) as area, cast(ts as date) as date, cast(hour(ts) as integer) as hour,
             sum(cast(round(value * 100) as bigint)) // count(*) / 100 as t0, cast(count(*) as double) as w0
      from events where event_type <> 'click' group by 1, 2, 3),
    every as (select t.*, r.t0, r.w0 from feat t left join reading r using (area, date, hour)),
    middle as (select quantile_cont(t0, 0.5) as mt, quantile_cont(w0, 0.5) as mw from every),
    filled as (select every.*, coalesce(t0, mt) as temp, coalesce(w0, mw) as wspeed from every, middle),
    m as (select min(incident_id) as incident_id, {_model(_LEARN_SQL)} from filled group by all),
    placed as (select *, row_number() over (order by datetime_key, incident_id) as rn, count(*) over () as total from m),
    test as (select * from placed where rn > floor(total * 0.8)),
    fit as (select * from placed where rn <= floor(total * 0.8)) """
)
oracle(
    "ml1_smote",
    LEARN
    + """, c as (select is_hourly_hotspot, count(*) as n from fit group by 1)
    select is_hourly_hotspot, false as is_synthetic, n from c
    union all select is_hourly_hotspot, true, (select max(n) - min(n) from c) from c
    where n < (select max(n) from c)""",
)
oracle(
    "ml1b_smote_copies",
    LEARN
    + f""", c as (select is_hourly_hotspot, count(*) as n from fit group by 1),
    few as (
      select incident_id, row_number() over (order by {drawn("incident_id", "42")}) as place, count(*) over () as n_few,
             (select max(n) - min(n) from c) as n_new
      from fit where is_hourly_hotspot = (select is_hourly_hotspot from c order by n, 1 limit 1))
    select incident_id, n_new // n_few + cast(place <= n_new % n_few as bigint) as n from few
    where n_new // n_few + cast(place <= n_new % n_few as bigint) > 0""",
)
_FOLDS = f"folded as (select *, cast({drawn('incident_id', '42')} % 5 as integer) as fold from fit)"
oracle(
    "ml8b_resampled_folds",
    LEARN
    + f""", {_FOLDS},
    sizes as (
      select k::integer as fold, is_hourly_hotspot, count(*) as n from folded, range(5) r(k) where folded.fold <> k group by all),
    parts as (
      select fold, 'fit' as part, is_hourly_hotspot, false as is_synthetic, n from sizes
      union all
      select fold, 'fit', arg_min(is_hourly_hotspot, n), true, max(n) - min(n) from sizes group by fold
      union all
      select fold, 'held', is_hourly_hotspot, false, count(*) from folded group by 1, 3)
    select * from parts where n > 0""",
)
oracle(
    "ml11b_out_of_fold_scores",
    LEARN
    + f""", {_FOLDS}
    select fold, count(*) as n_rows, cast(sum(is_hourly_hotspot) as bigint) as n_positive, count(*) as n_in_range, true as separates
    from folded group by fold""",
)
oracle(
    "ml6b_balanced_draws",
    LEARN
    + f""", c as (select is_hourly_hotspot, count(*) as n from fit group by 1),
    small as (select arg_min(is_hourly_hotspot, n) as label, min(n)::double / max(n) as keep from c)
    select t::integer as tree, is_hourly_hotspot, count(*) as n
    from fit, small, range(50) r(t)
    where is_hourly_hotspot = label or {drawn("incident_id", "42", "t", digits=13)} / 4503599627370496::double < keep group by all""",
)
oracle(
    "ml4c_patience_on_given_rows",
    LEARN
    + """select cast(200 as bigint) as n_rounds, cast(2 * (select max(n) from (select count(*) as n from fit group by is_hourly_hotspot)) as bigint) as n_fit,
         count(*) as n_evaluation, true as in_order, true as is_first_best, true as cut_agrees from test""",
)
oracle("ml5b_random_cuts", "select cast(50 as bigint) as n_trees, cast(0 as bigint) as n_shared_cuts, cast(0 as bigint) as n_outside")
oracle(
    "ml9b_grid_checks",
    LEARN
    + """select cast(24 as bigint) as n_points, cast(5 as bigint) as n_folds, count(*) as least_rows, count(*) as most_rows,
         true as in_range, true as differ, true as beats_majority from fit""",
)
_RULE = {"was_hourly_hotspot_last_hour": "wh", "hour_sin": "hs", "was_daily_hotspot_yesterday": "wd", "month_sin": "ms"}


def _rule(of: dict[str, str]) -> str:
    """Whether the fixed rule is right, with these expressions for its four inputs."""
    wh, hs, wd, ms = (of[c] for c in _RULE)
    return f"avg(cast((({wh} = 1 and {hs} > 0.1) or ({wd} = 1 and {ms} < -0.3)) = (a.y = 1) as double))"


_OWN = {c: f"a.{s}" for c, s in _RULE.items()}
oracle(
    "ev6b_permutation_of_a_rule",
    LEARN
    + f""", given as (
      select incident_id, is_hourly_hotspot as y, {", ".join(f"{c} as {s}" for c, s in _RULE.items())} from test),
    lots as (
      select given.*, r, {drawn("incident_id", "r", "43", digits=13)} as u1, {drawn("incident_id", "r", "44", digits=13)} as u2
      from given, range(3) x(r)),
    places as (
      select *, row_number() over (partition by r order by u1, incident_id) as p1, row_number() over (partition by r order by u2, incident_id) as p2
      from lots),
    plain as (select {_rule(_OWN)} as p from given a),
    pairs as (
      select {", ".join(f"{_rule(_OWN | {c: f'b.{s}'})} as {s}" for c, s in _RULE.items())}
      from places a join places b on a.r = b.r and a.p1 = b.p2)
    select feature, round(importance, 6) + 0.0 as importance from (
      {" union all ".join(f"select '{c}' as feature, p - {s} as importance from plain, pairs" for c, s in _RULE.items())}
      union all select unnest([{", ".join(f"'{c.lower()}'" for c in MODEL_INPUT if c.lower() not in _RULE)}]), 0.0)""",
)
oracle("ev5c_importance_from_nodes", "select cast(15 as bigint) as n_agree, cast(12 as bigint) as n_top")
oracle(
    "ev11b_scoring_checks",
    LEARN + "select f as format, count(*) as n_rows, count(*) as n_sums, count(*) as n_agree from test, (values ('json'), ('csv')) x(f) group by 1",
)
oracle(
    "ml7b_family_checks",
    LEARN
    + """select f as model, count(*) as n_rows, cast(sum(is_hourly_hotspot) as bigint) as n_positive, count(*) as n_in_range, true as separates
    from test, (values ('balanced_random_forest'), ('catboost'), ('catboost_weighted'), ('extra_trees'), ('random_forest'), ('xgboost')) x(f) group by 1""",
)
oracle(
    "ev5b_importance_sums",
    LEARN + "select cast(15 as bigint) as n_features, 1.0::double as total, true as none_negative, count(*) as n_test from test",
)

# ------------------------------------------------------------------ crowded hours, the whole processing run
_LINES = """
ev as (
  select l_orderkey * 1000 + l_linenumber as incident_id, cast(min(l_suppkey) % 2 as integer) as area,
         date_trunc('month', min(l_shipdate))::timestamp as hour_ts from lineitem group by l_orderkey, l_linenumber),
ev_pop as (
  select cast(l_suppkey % 2 as integer) as area, count(distinct l_suppkey) * 1000 as population from lineitem group by 1)
"""
oracle(
    "wn4b_crowded_hours",
    with_(EV_TRAIL.replace(EV, _LINES))
    + """select incident_id, area, round(hourly_rate, 6) as hourly_rate, is_hourly_hot, round(rolling_mean, 6) as rolling_mean,
         round(rate_last_row, 6) as rate_last_row, round(rate_last_6_sum, 6) as rate_last_6_sum, was_hourly_hot_last_row from trail""",
)
_REPORTS = f"""
ev as (
  select dr_no as incident_id, upper(area_name) as area, cast(occurred as date) as date,
         cast(cast(occurred as date) as timestamp) + to_hours(time_occ // 100) as hour_ts
  from (select *, {PARSED.format('date_occ')} as occurred from raw)
  where coalesce(vict_sex, 'X') <> '-' and premis_cd is not null and status is not null and year(occurred) <= 2000),
ev_pop as (
  select upper(n_name) as area, count(*) * 1000 as population from customer join nation on c_nationkey = n_nationkey group by 1)
"""
oracle(
    "ds6_processing_run",
    with_(RAW, EV_TRAIL.replace(EV, _REPORTS), EV_SPLIT.format(src="trail"))
    + """, reading as (
      select l_orderkey as incident_id, (cast(sum(cast(l_quantity as bigint)) as bigint) * 10000 // count(*)) / 10000 as t0,
             (cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) * 100 // count(*)) / 10000 as w0
      from lineitem group by 1),
    every as (select h.*, t0, w0 from halves h left join reading using (incident_id)),
    middle as (select median(t0) as mt, median(w0) as mw from every)
    select split, is_hourly_hot as is_hourly_hotspot, count(*) as n_rows, cast(COLUMNS_HERE as integer) as n_features,
           round(avg(coalesce(t0, mt)), 4) as temp, round(avg(coalesce(w0, mw)), 4) as wspeed
    from every, middle group by 1, 2""".replace("COLUMNS_HERE", str(len([c for c in MODEL_SQL if c not in DROPPED]) + 2)),
)
