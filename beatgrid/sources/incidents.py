"""Input schemas and the step from raw reports to the tidy incident shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatgrid.functions import calendar as cal
from beatgrid.functions import encode

# The 28 columns of the raw incident report.
INCIDENT_SCHEMA = """
    `DR_NO` bigint, `Date Rptd` string, `DATE OCC` string, `TIME OCC` int, `AREA` int,
    `AREA NAME` string, `Rpt Dist No` int, `Part 1-2` int, `Crm Cd` double,
    `Crm Cd Desc` string, `Mocodes` string, `Vict Age` int, `Vict Sex` string,
    `Vict Descent` string, `Premis Cd` double, `Premis Desc` string,
    `Weapon Used Cd` double, `Weapon Desc` string, `Status` string, `Status Desc` string,
    `Crm Cd 1` double, `Crm Cd 2` double, `Crm Cd 3` double, `Crm Cd 4` double,
    `LOCATION` string, `Cross Street` string, `LAT` double, `LON` double
"""

# The weather table. Numbers arrive as text and are coerced in cleaning.
WEATHER_SCHEMA = """
    `DR_NO` bigint, `AREA NAME` string, `DATE OCC` string, `Hour` int,
    `Temp` string, `Wspeed` string, `Prec` string, `Sun_time` string
"""

REQUIRED = ("DR_NO", "DATE OCC", "TIME OCC", "AREA NAME")


def require(df: DataFrame, columns: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def tidy(cleaned: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Cleaned reports -> one row per incident with short column names."""
    require(cleaned)
    optional = {
        "Crm Cd": "offence_code",
        "Crm Cd Desc": "offence",
        "Vict Age": "victim_age",
        "Vict Sex": "victim_sex",
        "Status": "status",
        "LAT": "lat",
        "LON": "lon",
    }
    out = cleaned.select(
        F.col("DR_NO").alias("incident_id"),
        F.upper("AREA NAME").alias("area"),
        F.to_date("DATE OCC").alias("date"),
        cal.hour_of_hhmm(F.col("TIME OCC")).alias("hour"),
        *[F.col(f"`{raw}`").alias(new) for raw, new in optional.items() if raw in cleaned.columns],
        *(
            [encode.severity(F.col("`Part 1-2`")).alias("severity")]
            if "Part 1-2" in cleaned.columns
            else []
        ),
        *(
            [encode.descent_group(F.col("`Vict Descent`")).alias("descent")]
            if "Vict Descent" in cleaned.columns
            else []
        ),
    )
    if categories is not None and "offence" in out.columns:
        out = encode.with_category(out, categories, "offence")
    return out


def tidy_weather(cleaned: DataFrame) -> DataFrame:
    """Cleaned weather -> short column names; keeps whichever keys are present."""
    names = {
        "DR_NO": "incident_id",
        "AREA NAME": "area",
        "DATE OCC": "date",
        "Hour": "hour",
        "Temp": "temp",
        "Wspeed": "wspeed",
        "Prec": "prec",
        "Sun_time": "sun_time",
    }
    out = cleaned.select(
        *[F.col(f"`{raw}`").alias(new) for raw, new in names.items() if raw in cleaned.columns]
    )
    if "date" in out.columns:
        out = out.withColumn("date", F.to_date("date"))
    if "area" in out.columns:
        out = out.withColumn("area", F.upper("area"))
    return out
