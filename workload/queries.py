"""Every operator as a query over the given tables, keyed by inventory id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatgrid import dimensions
from beatgrid.config import CleaningParams, HotspotParams, WeatherParams
from beatgrid.functions import calendar as cal
from beatgrid.functions import encode
from beatgrid.learn import evaluate as ev
from beatgrid.operators import clean, enrich, grains, profile, splits, stats
from beatgrid.operators.ordered import quantiles
from beatgrid.operators.trail import incident_trail
from beatgrid.plans import cleaning, features
from beatgrid.sources import files, incidents as raw_incidents
from beatgrid.sources import stand_ins as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
P = CleaningParams()


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, everything else as it is."""
    return df.select(
        *[
            (F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`"))
            for c, t in df.dtypes
        ]
    )


def snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_").replace("-", "_") for c in df.columns])


# ------------------------------------------------------------------ sources and sinks

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def _round_trip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = files.scratch_path(spark, f"events-{fmt}")
    files.write_table(src.table(spark, sf_dir, "events"), path, fmt)
    return files.read_table(spark, path, fmt, EVENT_SCHEMA)


@query("io1_csv_scan")
def io1(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query("io2_parquet_scan")
def io2(spark, sf_dir):
    return files.read_table(spark, f"{sf_dir}/events.parquet").filter(
        (F.col("event_type") == "error") & (F.col("value") > 10)
    ).select("event_id", "ts", "value")


@query("io3_json_round_trip")
def io3(spark, sf_dir):
    return _round_trip(spark, sf_dir, "json")


@query("io4_parquet_sink")
def io4(spark, sf_dir):
    return _round_trip(spark, sf_dir, "parquet")


@query("io5_split_sink")
def io5(spark, sf_dir):
    path = files.scratch_path(spark, "split")
    files.write_split(_event_split(spark, sf_dir), path)
    return files.read_table(spark, path).groupBy("split").agg(F.count("*").alias("n"))


@query("io6_split_metadata")
def io6(spark, sf_dir):
    return files.split_metadata(_split_and_flagged(spark, sf_dir), "is_hourly_hot")


@query("io7_run_versions")
def io7(spark, sf_dir):
    base = files.scratch_path(spark, "runs")
    counted = profile.count_by(src.event_incidents(spark, sf_dir), ["category"])
    for run_id in ("run_20240101_000000_a", "run_20240102_000000_b"):
        files.write_run(counted, base, "evaluation", run_id)
    runs = files.list_runs(spark, base, "evaluation")
    table = spark.read.parquet(f"{base}/evaluation")
    return runs.join(table.groupBy("run_id").agg(F.sum("n").alias("n_rows")), "run_id")


@query("io8_district_attributes")
def io8(spark, sf_dir):
    return files.read_table(spark, f"{sf_dir}/nation.parquet").select(
        F.col("n_nationkey").alias("station"), F.col("n_name").alias("district"), "n_regionkey"
    )


# ------------------------------------------------------------------ cleaning


@query("cl1_drop_columns")
def cl1(spark, sf_dir):
    cols = ["DR_NO", "AREA", "Crm Cd 4", "Cross Street"]
    return snake(clean.drop_columns(src.raw_reports(spark, sf_dir).select(*cols), P.drop))


@query("cl2_fill_constants")
def cl2(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", *P.fill)
    return snake(clean.fill_constants(df, P.fill))


@query("cl3_fill_mode")
def cl3(spark, sf_dir):
    return snake(clean.fill_mode(src.raw_reports(spark, sf_dir).select("DR_NO", "Mocodes"), "Mocodes"))


@query("cl4_drop_invalid_code")
def cl4(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", "Vict Sex")
    return snake(clean.drop_value(clean.fill_constants(df, {"Vict Sex": "X"}), "Vict Sex", "-"))


@query("cl5_drop_nulls")
def cl5(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", "Premis Cd", "Status")
    return snake(clean.drop_nulls(df, P.required))


@query("cl6_parse_dates")
def cl6(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", "DATE OCC", "Date Rptd")
    return snake(clean.parse_dates(df, P.dates, P.date_formats))


@query("cl6b_parse_event_text")
def cl6b(spark, sf_dir):
    text = F.when(F.col("event_id") % 7 == 0, "bad").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    df = src.table(spark, sf_dir, "events").select("event_id", text.alias("ts_text"))
    return clean.parse_dates(df, ["ts_text"], P.date_formats)


@query("cl7_repair_age")
def cl7(spark, sf_dir):
    df = src.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(clean.repair_age(df, "c_acctbal", upper=5000.0))


@query("cl8_allow_values")
def cl8(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", "Vict Sex")
    return snake(clean.allow_values(df, "Vict Sex", P.sex_values, "X"))


@query("cl9_until_year")
def cl9(spark, sf_dir):
    df = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return clean.until_year(df, "o_orderdate", 1999)


@query("cl10_upper_case")
def cl10(spark, sf_dir):
    cols = ["DR_NO", *P.upper]
    return snake(clean.upper_case(src.raw_reports(spark, sf_dir).select(*cols), P.upper))


@query("cl11_coerce_numbers")
def cl11(spark, sf_dir):
    text = F.when(F.col("event_id") % 5 == 0, F.col("props")).otherwise(
        F.regexp_extract("props", r"(\d+)", 1)
    )
    df = src.table(spark, sf_dir, "events").select("event_id", text.alias("reading"))
    return clean.coerce_numbers(df, ["reading"])


@query("cl12_dedupe_rows")
def cl12(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem")
    return clean.dedupe_rows(df.select("l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"))


@query("cl13_keep_first")
def cl13(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return clean.keep_first(df, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("cl14_clean_reports")
def cl14(spark, sf_dir):
    params = CleaningParams(max_year=2000)
    return rounded(snake(cleaning.clean_reports(src.raw_reports(spark, sf_dir), params)))


# ------------------------------------------------------------------ sorts and top-k


@query("tk1_most_recent")
def tk1(spark, sf_dir):
    df = src.event_incidents(spark, sf_dir).select("incident_id", "area", "ts", "category")
    return profile.most_recent(df, 1000, "ts", "incident_id")


@query("tk2_value_counts")
def tk2(spark, sf_dir):
    return profile.value_counts(src.event_incidents(spark, sf_dir), "area", 10)


@query("tk3_leading_trends")
def tk3(spark, sf_dir):
    rolled = profile.rolling_by_category(src.order_incidents(spark, sf_dir))
    return rounded(profile.leading_trends(rolled, "category"), 4)


@query("tk4_series_order")
def tk4(spark, sf_dir):
    # a range-partitioned sort; the id makes the order total and the ranges even
    df = src.event_incidents(spark, sf_dir).select("incident_id", "area", "hour_ts", "category")
    return df.orderBy("area", "hour_ts", "incident_id")


# ------------------------------------------------------------------ scalars


def _events(spark, sf_dir):
    return src.event_incidents(spark, sf_dir)


@query("sc1_date_parts")
def sc1(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "incident_id", *[c.alias(n) for n, c in cal.date_parts(F.col("date")).items()]
    )


@query("sc2_hour_of_hhmm")
def sc2(spark, sf_dir):
    hhmm = (F.hour("ts") * 100 + F.minute("ts")).cast("int")
    return _events(spark, sf_dir).select(
        "incident_id", hhmm.alias("hhmm"), cal.hour_of_hhmm(hhmm).alias("hour")
    )


@query("sc3_hour_key")
def sc3(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "incident_id",
        "date",
        "hour_ts",
        cal.hour_stamp(F.col("date"), F.col("hour")).alias("date_plus_hour"),
    )


@query("sc4_period_keys")
def sc4(spark, sf_dir):
    keys = cal.period_keys(F.col("date"), F.col("hour"))
    return _events(spark, sf_dir).select("incident_id", *[c.alias(n) for n, c in keys.items()])


@query("sc5_cycles")
def sc5(spark, sf_dir):
    cyc = cal.cycles(F.col("date"), F.col("hour"))
    df = _events(spark, sf_dir).select("incident_id", *[c.alias(n) for n, c in cyc.items()])
    return rounded(df, 9)


@query("sc6_weekend_flags")
def sc6(spark, sf_dir):
    flags = cal.week_flags(F.col("date"))
    return _events(spark, sf_dir).select(
        "incident_id", *[flags[n].alias(n) for n in ("weekend", "is_weekend", "week_type")]
    )


@query("sc7_holiday_flag")
def sc7(spark, sf_dir):
    # order dates moved on by 23 years so that Juneteenth and its first years are covered
    later = F.add_months("date", 12 * 23)
    return src.order_incidents(spark, sf_dir).select(
        "incident_id",
        "date",
        cal.is_us_holiday(F.col("date")).alias("is_holiday"),
        later.alias("later_date"),
        cal.is_us_holiday(later).alias("later_is_holiday"),
    )


@query("sc8_weekend_or_holiday")
def sc8(spark, sf_dir):
    flags = cal.week_flags(F.col("date"))
    return src.order_incidents(spark, sf_dir).select(
        "incident_id", flags["is_weekend_or_holiday"].alias("is_weekend_or_holiday")
    )


@query("sc9_dictionary_map")
def sc9(spark, sf_dir):
    # Two small lookups over the event types and one as a joined table
    groups = spark.createDataFrame(
        [("click", "USE"), ("view", "USE"), ("purchase", "SALE"), ("signup", "SALE")],
        "event_type string, category string",
    )
    df = _events(spark, sf_dir).select(
        "incident_id",
        F.col("category").alias("offence"),
        (F.col("incident_id") % 3).cast("int").alias("class_code"),
    )
    return encode.with_category(df, groups, "offence", "event_type").withColumn(
        "severity", encode.severity(F.col("class_code"))
    )


@query("sc10_code_groups")
def sc10(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select("DR_NO", F.col("`Vict Descent`").alias("code"))
    return snake(df.withColumn("descent", encode.descent_group(F.col("code"))))


@query("sc11_date_shift")
def sc11(spark, sf_dir):
    d = F.col("date")
    return src.order_incidents(spark, sf_dir).select(
        "incident_id",
        F.date_add(d, 1).alias("next_day"),
        F.date_sub(d, 1).alias("prev_day"),
        cal.same_day_last_year(d).alias("last_year"),
    )


@query("sc12_label_bins")
def sc12(spark, sf_dir):
    temp = F.col("l_quantity") * 2
    return src.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", encode.temperature_band(temp).alias("temp_category")
    )


@query("sc13_night_value")
def sc13(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "incident_id", encode.night_value(F.col("value"), F.col("hour")).alias("night_value")
    )


@query("sc14_high_flag")
def sc14(spark, sf_dir):
    df = src.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return enrich.high_flag(df, "l_extendedprice", "is_high").drop("l_extendedprice")


@query("sc15_temporal_features")
def sc15(spark, sf_dir):
    df = _events(spark, sf_dir).select("incident_id", "date", "hour")
    return rounded(cal.with_temporal(df), 9)


# ------------------------------------------------------------------ aggregations


@query("ag1_hourly_rate")
def ag1(spark, sf_dir):
    return rounded(grains.rates(_events(spark, sf_dir), src.event_population(spark, sf_dir), "hourly"))


def _order_rates(spark, sf_dir, grain):
    return rounded(
        grains.rates(src.order_incidents(spark, sf_dir), src.order_population(spark, sf_dir), grain)
    )


@query("ag2_daily_rate")
def ag2(spark, sf_dir):
    return _order_rates(spark, sf_dir, "daily")


@query("ag3_monthly_rate")
def ag3(spark, sf_dir):
    return _order_rates(spark, sf_dir, "monthly")


@query("ag4_yearly_rate")
def ag4(spark, sf_dir):
    return _order_rates(spark, sf_dir, "yearly")


@query("ag5_centroids")
def ag5(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select("incident_id", "area", "price", "balance")
    return rounded(grains.with_centroids(df, "price", "balance"), 4)


def _order_parts(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir)
    return df.withColumns({n: c for n, c in cal.date_parts(F.col("date")).items()})


@query("ag6_counts_by_period")
def ag6(spark, sf_dir):
    return profile.count_by(_order_parts(spark, sf_dir), ["year", "quarter", "month"])


@query("ag6b_counts_by_date")
def ag6b(spark, sf_dir):
    return profile.count_by(src.order_incidents(spark, sf_dir), ["date"])


@query("ag7_average_per_month")
def ag7(spark, sf_dir):
    return rounded(profile.average_per_year(_order_parts(spark, sf_dir), "month"))


@query("ag7b_average_per_quarter")
def ag7b(spark, sf_dir):
    return rounded(profile.average_per_year(_order_parts(spark, sf_dir), "quarter"))


@query("ag8_weekday_hour_pivot")
def ag8(spark, sf_dir):
    df = _events(spark, sf_dir).withColumn("day_of_week", F.weekday("date"))
    return profile.pivot_counts(df, "day_of_week", "hour", "h", range(24))


@query("ag9_cross_tab")
def ag9(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir)
    return profile.pivot_counts(df, "category", "code", "code_", fill=0)


@query("ag10_year_by_code")
def ag10(spark, sf_dir):
    return profile.pivot_counts(_order_parts(spark, sf_dir), "year", "code", "code_", fill=0)


@query("ag11_row_shares")
def ag11(spark, sf_dir):
    flag = cal.week_flags(F.col("date"))["is_weekend_or_holiday"]
    df = _order_parts(spark, sf_dir).withColumn("is_weekend_or_holiday", flag)
    return rounded(profile.shares(df, "year", "is_weekend_or_holiday"))


@query("ag11b_calendar_shares")
def ag11b(spark, sf_dir):
    flag = cal.week_flags(F.col("date"))["is_weekend_or_holiday"]
    days = src.order_incidents(spark, sf_dir).select("date").distinct()
    df = days.select(F.year("date").alias("year"), flag.alias("is_weekend_or_holiday"))
    return rounded(profile.shares(df, "year", "is_weekend_or_holiday"))


@query("ag12_describe")
def ag12(spark, sf_dir):
    return rounded(profile.describe(_events(spark, sf_dir), "value"))


@query("ag13_table_summary")
def ag13(spark, sf_dir):
    df = snake(src.raw_reports(spark, sf_dir)).withColumn(
        "date_occ", cal.parse_timestamp(F.col("date_occ"), P.date_formats)
    )
    cols = ["date_occ", "mocodes", "vict_sex", "premis_cd", "status", "weapon_used_cd"]
    return profile.table_summary(df, cols, "date_occ", "area_name")


@query("ag14_five_numbers")
def ag14(spark, sf_dir):
    return rounded(profile.five_numbers(src.order_incidents(spark, sf_dir), "price", "category"))


@query("ag14b_daily_counts_box")
def ag14b(spark, sf_dir):
    return rounded(profile.five_numbers(_daily_counts(spark, sf_dir), "n", "week_type"))


@query("ag15_histogram")
def ag15(spark, sf_dir):
    return rounded(profile.histogram(_events(spark, sf_dir), "value", 50))


@query("ag16_headline")
def ag16(spark, sf_dir):
    df = _events(spark, sf_dir).withColumn("weekend", cal.week_flags(F.col("date"))["weekend"])
    return rounded(profile.headline(df, "weekend", "area", "category"))


@query("ag17_class_balance")
def ag17(spark, sf_dir):
    return rounded(splits.class_balance(_split_and_flagged(spark, sf_dir), "is_hourly_hot"))


# ------------------------------------------------------------------ windows


def _hourly_hot(spark, sf_dir):
    return incident_trail(
        _events(spark, sf_dir), src.event_population(spark, sf_dir), HotspotParams()
    )


def _split_and_flagged(spark, sf_dir):
    """The cut needs hour and id only, so it is found before the flags are computed."""
    parts = _event_split(spark, sf_dir)
    flagged = incident_trail(parts, src.event_population(spark, sf_dir))
    return flagged.select("incident_id", "hour_ts", "area", "split", "is_hourly_hot")


def _trail_query(name: str, *columns: str) -> None:
    @query(name)
    def run(spark, sf_dir):
        return rounded(_hourly_hot(spark, sf_dir).select("incident_id", "area", *columns))


_trail_query("wn1_rolling_mean", "rolling_mean")
_trail_query("wn2_rolling_std", "rolling_std")
_trail_query("wn3_z_score", "z_score")
_trail_query("wn4_hourly_hot", "hourly_rate", "is_hourly_hot")
_trail_query("wn8_lag_rate", "rate_last_row")
_trail_query("wn9_mean_last_3", "rate_last_3_avg")
_trail_query("wn10_sum_last_6", "rate_last_6_sum")
_trail_query("wn11_lag_hot", "was_hourly_hot_last_row")


def _order_cube(spark, sf_dir):
    return grains.hour_cube(src.order_incidents(spark, sf_dir), src.order_population(spark, sf_dir))


def _hot(spark, sf_dir, grain, period):
    cells = grains.period_cells(_order_cube(spark, sf_dir), grain)
    return rounded(grains.hot_cells(cells, period, 0.75))


@query("wn5_daily_hot")
def wn5(spark, sf_dir):
    return _hot(spark, sf_dir, "daily", ["date"])


@query("wn6_monthly_hot")
def wn6(spark, sf_dir):
    return _hot(spark, sf_dir, "monthly", ["year", "month"])


@query("wn7_yearly_hot")
def wn7(spark, sf_dir):
    return _hot(spark, sf_dir, "yearly", ["year"])


@query("wn12_rolling_30_days")
def wn12(spark, sf_dir):
    return rounded(profile.rolling_daily(src.order_incidents(spark, sf_dir)))


@query("wn13_rolling_by_category")
def wn13(spark, sf_dir):
    return rounded(profile.rolling_by_category(src.order_incidents(spark, sf_dir)))


@query("wn14_split_per_area")
def wn14(spark, sf_dir):
    df = _events(spark, sf_dir).select("incident_id", "area", "hour_ts")
    return splits.split_by_group(df)


# ------------------------------------------------------------------ joins


@query("jn1_rates_on_rows")
def jn1(spark, sf_dir):
    cube = grains.hour_cube(_events(spark, sf_dir), src.event_population(spark, sf_dir))
    df = _events(spark, sf_dir).select("incident_id", "area", "hour_ts")
    return rounded(grains.rates_to_rows(df, cube))


@query("jn2_population_join")
def jn2(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select(
        "incident_id", "area", F.year("date").alias("year")
    )
    return grains.with_population(df, src.order_population(spark, sf_dir))


@query("jn3_same_hour_yesterday")
def jn3(spark, sf_dir):
    cube = grains.hour_cube(_events(spark, sf_dir), src.event_population(spark, sf_dir))
    df = _events(spark, sf_dir).select("incident_id", "area", "hour_ts")
    yesterday = features.with_yesterday(cube).select("area", "hour_ts", "rate_yesterday_same_hour")
    return rounded(df.join(yesterday, ["area", "hour_ts"], "left"))


def _day_lookup(spark, sf_dir, column):
    df = src.order_incidents(spark, sf_dir).select("incident_id", "area", "date")
    days = features.day_flags(_order_cube(spark, sf_dir))
    return df.join(days.select("area", "date", column), ["area", "date"], "left")


@query("jn4_hot_yesterday")
def jn4(spark, sf_dir):
    return _day_lookup(spark, sf_dir, "was_daily_hot_yesterday")


@query("jn5_hot_last_year")
def jn5(spark, sf_dir):
    return _day_lookup(spark, sf_dir, "was_hot_last_year")


WEATHER_BY_DAY = WeatherParams(keys=("area", "date"))


@query("jn6_weather_median_fill")
def jn6(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select("incident_id", "area", "date")
    return rounded(enrich.add_weather(df, src.ship_weather(spark, sf_dir), WEATHER_BY_DAY))


@query("jn6b_weather_zero_fill")
def jn6b(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select("incident_id", "area", "date")
    params = WeatherParams(keys=("area", "date"), fill=0.0)
    return rounded(
        enrich.add_weather(df, src.ship_weather(spark, sf_dir), params, unique_ids=True)
    )


@query("jn6c_weather_interactions")
def jn6c(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select("incident_id", "area", "date", "hour")
    joined = enrich.add_weather(df, src.ship_weather(spark, sf_dir), WEATHER_BY_DAY, unique_ids=True)
    return rounded(enrich.weather_interactions(joined))


@query("jn7_district_counts")
def jn7(spark, sf_dir):
    districts = src.table(spark, sf_dir, "nation").filter(F.col("n_nationkey") != 3)
    out = None
    for how in ("left", "right"):
        part = profile.area_counts_on_districts(
            src.order_incidents(spark, sf_dir), districts, "n_nationkey", how
        ).withColumn("how", F.lit(how))
        out = part if out is None else out.unionByName(part)
    return out


@query("jn8_request_keys")
def jn8(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir)
    return rounded(enrich.request_keys(df, grains.centroids(df, "price", "balance")), 4)


@query("jn9_top_area_per_category")
def jn9(spark, sf_dir):
    return profile.top_area_per_category(src.order_incidents(spark, sf_dir))


# ------------------------------------------------------------------ splits


def _event_split(spark, sf_dir):
    return splits.split_by_time(_events(spark, sf_dir).select("incident_id", "area", "hour_ts"))


@query("st1_union_splits")
def st1(spark, sf_dir):
    flagged = splits.split_by_group(_events(spark, sf_dir).select("incident_id", "area", "hour_ts"))
    train = flagged.filter(F.col("split") == "train").drop("split")
    test = flagged.filter(F.col("split") == "test").drop("split")
    return splits.union_splits(train, test)


@query("st2_time_split")
def st2(spark, sf_dir):
    return _event_split(spark, sf_dir)


@query("st3_validation_split")
def st3(spark, sf_dir):
    train = _event_split(spark, sf_dir).filter(F.col("split") == "train").drop("split")
    return splits.validation_split(train)


@query("st4_stratified_split")
def st4(spark, sf_dir):
    flagged = _hourly_hot(spark, sf_dir).select("incident_id", "is_hourly_hot")
    return splits.split_stratified(flagged, "is_hourly_hot")


@query("st4b_stratified_sizes")
def st4b(spark, sf_dir):
    flagged = _hourly_hot(spark, sf_dir).select("incident_id", "is_hourly_hot")
    parts = splits.split_stratified(flagged, "is_hourly_hot")
    return parts.groupBy("is_hourly_hot", "split").agg(F.count("*").alias("n"))


@query("st5_features_target")
def st5(spark, sf_dir):
    table = _event_model_table(spark, sf_dir, features.CORRELATED)
    names = splits.numeric_features(
        table, features.LABEL, exclude=("Hourly_Crime_Rate_per_1000", "Datetime_Key", "AREA NAME", "incident_id")
    )
    return rounded(
        table.select(
            "incident_id", *[F.col(f"`{c}`").alias(c.lower()) for c in names], features.LABEL
        )
    )


# ------------------------------------------------------------------ statistics


def _daily_counts(spark, sf_dir):
    daily = profile.count_by(src.order_incidents(spark, sf_dir), ["date"])
    return daily.withColumn("week_type", cal.week_flags(F.col("date"))["week_type"])


@query("sa1_mann_whitney")
def sa1(spark, sf_dir):
    daily = _daily_counts(spark, sf_dir)
    return rounded(stats.mann_whitney(daily, "n", F.col("week_type") == "Weekday"), 4)


@query("sa1b_mann_whitney_rows")
def sa1b(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir)
    first = F.when(F.col("code") == "F", True).when(F.col("code") == "O", False)
    return rounded(stats.mann_whitney(df, "price", first), 4)


@query("sa1c_mann_whitney_code_frequency")
def sa1c(spark, sf_dir):
    df = src.raw_reports(spark, sf_dir).select(
        F.col("`Crm Cd`").alias("code"),
        cal.parse_timestamp(F.col("`DATE OCC`"), P.date_formats).cast("date").alias("date"),
    ).filter(F.col("date").isNotNull())
    weekend = df.withColumn("weekend", cal.week_flags(F.col("date"))["weekend"])
    per_code = profile.count_by(weekend, ["weekend", "code"])
    return rounded(stats.mann_whitney(per_code, "n", F.col("weekend") == "Weekend"), 4)


@query("sa2_chi_square")
def sa2(spark, sf_dir):
    return rounded(stats.chi_square(src.order_incidents(spark, sf_dir), "category", "code"))


@query("sa2b_chi_square_2x2")
def sa2b(spark, sf_dir):
    df = src.order_incidents(spark, sf_dir).select(
        (F.col("price") > 200000).alias("dear"), (F.col("balance") > 0).alias("solvent")
    )
    return rounded(stats.chi_square(df, "dear", "solvent"))


@query("sa3_normality")
def sa3(spark, sf_dir):
    return rounded(stats.jarque_bera(_daily_counts(spark, sf_dir), "n", "week_type"), 5)


CORRELATION_COLUMNS = [
    "hourly_rate", "daily_rate", "monthly_rate", "yearly_rate", "rate_last_row",
    "rate_last_3_avg", "rate_last_6_sum", "rate_yesterday_same_hour",
    "was_hourly_hot_last_row", "was_daily_hot_yesterday", "hour_sin", "hour_cos",
    "day_of_week_sin", "day_of_week_cos", "is_hourly_hot",
]


@query("sa4_correlations")
def sa4(spark, sf_dir):
    return rounded(stats.correlations(_event_features(spark, sf_dir), CORRELATION_COLUMNS))


@query("sa5_drop_correlated")
def sa5(spark, sf_dir):
    table = features.model_table(_event_features(spark, sf_dir), drop=(), keep=["incident_id"])
    kept = stats.drop_correlated(table, features.CORRELATED)
    return rounded(_lower(kept))


# ------------------------------------------------------------------ dataset


def _lower(df: DataFrame) -> DataFrame:
    return snake(df)


def _event_features(spark, sf_dir):
    base = _events(spark, sf_dir).select("incident_id", "area", "date", "hour", "category")
    return features.engineer(base, src.event_population(spark, sf_dir))


def _event_model_table(spark, sf_dir, drop):
    return features.model_rows(_event_features(spark, sf_dir), drop)


@query("ds1_features")
def ds1(spark, sf_dir):
    return rounded(_event_features(spark, sf_dir))


@query("ds1b_features_with_weather")
def ds1b(spark, sf_dir):
    base = src.order_incidents(spark, sf_dir).select("incident_id", "area", "date", "hour")
    out = features.engineer(
        base,
        src.order_population(spark, sf_dir),
        src.ship_weather(spark, sf_dir),
        weather_params=WEATHER_BY_DAY,
    )
    return rounded(_lower(features.model_table(out, drop=(), keep=["incident_id"])))


@query("ds2_model_table")
def ds2(spark, sf_dir):
    return rounded(_lower(features.model_table(_event_features(spark, sf_dir))))


@query("ds2b_model_table_from_cells")
def ds2b(spark, sf_dir):
    base = _events(spark, sf_dir).select("incident_id", "area", "date", "hour")
    return rounded(
        _lower(features.model_table_from_cells(base, src.event_population(spark, sf_dir)))
    )


# ------------------------------------------------------------------ evaluation


def _rule_scores(spark, sf_dir):
    """Hourly hot label with three rule predictions in long form."""
    rows = _hourly_hot(spark, sf_dir).select(
        "incident_id",
        F.col("is_hourly_hot").alias("label"),
        F.coalesce(F.round("rate_last_row", 9), F.lit(0.0)).alias("last"),
        F.round("hourly_rate", 9).alias("now"),
    )
    rules = F.array(
        F.struct(F.lit("last_hour").alias("model"), F.least(F.col("last") * 4, F.lit(1.0)).alias("score")),
        F.struct(F.lit("same_hour").alias("model"), F.least(F.col("now") * 3, F.lit(1.0)).alias("score")),
        F.struct(F.lit("never").alias("model"), F.lit(0.0).alias("score")),
    )
    return rows.select("incident_id", "label", F.explode(rules).alias("r")).select(
        "incident_id",
        "label",
        "r.model",
        F.round("r.score", 6).alias("score"),
        (F.round("r.score", 6) > 0.5).cast("int").alias("prediction"),
    )


def _one_rule(spark, sf_dir):
    return _rule_scores(spark, sf_dir).filter(F.col("model") == "same_hour")


@query("ev1_confusion_matrix")
def ev1(spark, sf_dir):
    return ev.confusion_matrix(_one_rule(spark, sf_dir))


@query("ev2_metrics")
def ev2(spark, sf_dir):
    return rounded(ev.metrics(_one_rule(spark, sf_dir)))


@query("ev3_class_report")
def ev3(spark, sf_dir):
    return rounded(ev.class_report(_one_rule(spark, sf_dir)))


@query("ev4_roc_auc")
def ev4(spark, sf_dir):
    return rounded(ev.roc_auc(_one_rule(spark, sf_dir)))


@query("ev7_compare_models")
def ev7(spark, sf_dir):
    return rounded(ev.compare_models(_rule_scores(spark, sf_dir)))


@query("ev8_quality_gate")
def ev8(spark, sf_dir):
    return rounded(ev.quality_gate(ev.metrics(_rule_scores(spark, sf_dir), ["model"])))


@query("ev9_threshold_sweep")
def ev9(spark, sf_dir):
    return rounded(ev.threshold_sweep(_one_rule(spark, sf_dir)))


@query("ev10_evaluation_report")
def ev10(spark, sf_dir):
    return rounded(ev.evaluation_report(_one_rule(spark, sf_dir), 2, "same_hour"))


def _votes(spark, sf_dir):
    wide = _hourly_hot(spark, sf_dir).select(
        "incident_id",
        F.least(F.coalesce(F.round(F.col("rate_last_row") * 4, 6), F.lit(0.0)), F.lit(1.0)).alias("m1"),
        F.least(F.round(F.col("hourly_rate") * 3, 6), F.lit(1.0)).alias("m2"),
        F.coalesce("was_hourly_hot_last_row", F.lit(0)).cast("double").alias("m3"),
    )
    return wide


@query("ml10_voting")
def ml10(spark, sf_dir):
    wide = _votes(spark, sf_dir)
    weights = {"m1": 1.0, "m2": 2.0, "m3": 1.0}
    soft = ev.vote(wide, weights, "soft").withColumnsRenamed({"score": "soft_score", "prediction": "soft_vote"})
    both = ev.vote(soft, weights, "hard").withColumnRenamed("prediction", "hard_vote")
    return rounded(both.select("incident_id", "soft_score", "soft_vote", "hard_vote"))


# ------------------------------------------------------------------ crowded hours, the whole processing run


@query("wn4b_crowded_hours")
def wn4b(spark, sf_dir):
    out = incident_trail(src.line_incidents(spark, sf_dir), src.line_population(spark, sf_dir))
    cols = ["incident_id", "area", "hourly_rate", "is_hourly_hot", "rolling_mean", "rate_last_row", "rate_last_6_sum"]
    return rounded(out.select(*cols, "was_hourly_hot_last_row"))


@query("ds6_processing_run")
def ds6(spark, sf_dir):
    """Raw reports and weather -> clean -> tidy -> features -> split -> sink, and its metadata."""
    cleaned = cleaning.clean_reports(src.raw_reports(spark, sf_dir), CleaningParams(max_year=2000))
    tidy = raw_incidents.tidy(cleaned, dimensions.offence_groups(spark))
    weather = raw_incidents.tidy_weather(cleaning.clean_weather(src.order_weather(spark, sf_dir)))
    full = features.engineer(
        tidy.select("incident_id", "area", "date", "hour"), src.named_population(spark, sf_dir), weather
    )
    rows = files.materialised(features.model_table(full, keep=["incident_id"]), "rows")
    path = files.write_split(splits.split_by_time(rows, order="Datetime_Key"), files.scratch_path(spark, "dataset"))
    written = files.read_table(spark, path)
    about = files.split_metadata(written, features.LABEL).select("split", features.LABEL, "n_rows", "n_features")
    means = written.groupBy("split", features.LABEL).agg(F.avg("Temp").alias("temp"), F.avg("Wspeed").alias("wspeed"))
    return rounded(about.join(means, ["split", features.LABEL]), 4)
