"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mark in click columns for "this action is no click" (fixed value).
NO_CLICK = -1

# Sales levels of the areas (fixed values); every other area, and none, is the last level.
AREA_LEVELS = {
    "A Level": ("华北", "华东"),
    "B Level": ("华南", "华中"),
    "C Level": ("西南", "西北"),
}
OTHER_AREA_LEVEL = "D Level"


def parse_time(text: Column) -> Column:
    """Time from ``yyyy-MM-dd HH:mm:ss`` text, whose hour may lack its leading zero."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm:ss"))


def parse_date_key(text: Column) -> Column:
    """Day from ``yyyyMMdd`` text."""
    return F.to_date(text, "yyyyMMdd")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def date_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def date_key(day: Column) -> Column:
    """Day as ``yyyyMMdd`` text."""
    return F.date_format(day, "yyyyMMdd")


def minute_key(ts: Column) -> Column:
    """Minute as ``yyyyMMddHHmm`` text."""
    return F.date_format(ts, "yyyyMMddHHmm")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def id_list(text: Column) -> Column:
    """Ids of a comma list as an array; empty and non-numeric items are left out."""
    ids = F.transform(F.split(text, ","), lambda item: F.trim(item).try_cast("long"))
    return F.filter(ids, lambda item: item.isNotNull())


def joined(items: Column) -> Column:
    """Array as comma text; null where the array is empty."""
    return F.when(F.size(items) > 0, F.array_join(items, ","))


def non_empty(text: Column) -> Column:
    """The text, or null where it is empty."""
    return F.when(text != "", text)


def city_list(city_id: Column, city_name: Column) -> Column:
    """Aggregate: the distinct cities of a group, by id, as ``id:name`` comma text."""
    cities = F.array_sort(F.collect_set(F.struct(city_id.alias("id"), city_name.alias("name"))))
    return F.array_join(
        F.transform(cities, lambda city: F.concat(city["id"], F.lit(":"), city["name"])), ",")


def area_level(area: Column) -> Column:
    level = F
    for name, areas in AREA_LEVELS.items():
        level = level.when(area.isin(*areas), name)
    return level.otherwise(OTHER_AREA_LEVEL)


def product_status(extend_info: Column) -> Column:
    """``self`` for own goods (status 0 in the JSON), ``others`` for everything else."""
    own = F.get_json_object(extend_info, "$.product_status") == "0"
    return F.when(own, "self").otherwise("others")


def pair_text(first: Column, second: Column) -> Column:
    return F.concat_ws("_", first.cast("string"), second.cast("string"))
