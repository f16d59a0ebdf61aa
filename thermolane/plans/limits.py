"""Monthly range statistics, and control limits for the master from them."""

from pyspark.sql import DataFrame

from thermolane.operators import reshape, statistics as st

VALUES = ["indoor_temp", "set_temp"]


def monthly_tables(readings: DataFrame) -> dict:
    """Monthly statistics and fan-speed counts of running units, long."""
    on = st.on_only(readings)
    return {
        "monthly": st.monthly_statistics(on, VALUES),
        "fan_speed": st.fan_speed_counts(on),
    }


def monthly_report(readings: DataFrame, names) -> dict:
    """The six report tables, months down and the units `names` across."""
    tables = monthly_tables(readings)
    monthly, fans = tables["monthly"], tables["fan_speed"]
    out = {
        f"{v}_{s}": reshape.month_by_unit(monthly, f"{v}_{s}", names)
        for s in ("mean", "std")
        for v in VALUES
    }
    out["samples"] = reshape.month_by_unit(monthly, "samples", names, fill=0)
    counts = fans.groupBy("month", "fan_speed", "frequency").pivot("unit", list(names)).sum("n")
    out["fan_speed"] = counts.fillna(0, list(names))
    return out


def master_updates(readings: DataFrame, unit_area: DataFrame) -> DataFrame:
    on = st.on_only(readings)
    monthly = st.monthly_statistics(on, VALUES)
    limits = st.area_limits(st.with_area(st.unit_limits(monthly), unit_area))
    tops = st.with_area(st.top_speeds(on), unit_area)
    return st.limits_for_master(limits, st.area_speeds(tops), tops.select("area"))


def updated_master(master: DataFrame, readings: DataFrame, unit_area: DataFrame) -> DataFrame:
    return st.update_master(master, master_updates(readings, unit_area))
