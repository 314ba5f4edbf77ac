"""Schemas of the input tables and of the streaming result tables."""

from pyspark.sql.types import (DateType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields])


_LONG, _TEXT, _DATE = LongType(), StringType(), DateType()

# Actions as delivered: times are text, id lists are comma text, -1 stands for "no click".
ACTIONS_TEXT = _schema(
    ("date", _TEXT), ("user_id", _LONG), ("session_id", _TEXT), ("page_id", _LONG),
    ("action_time", _TEXT), ("search_keyword", _TEXT), ("click_category_id", _LONG),
    ("click_product_id", _LONG), ("order_category_ids", _TEXT), ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT), ("pay_product_ids", _TEXT), ("city_id", _LONG))

# Actions as stored: typed day (the partition column) and time.
ACTIONS = StructType([
    StructField(f.name, {"date": _DATE, "action_time": TimestampType()}.get(f.name, f.dataType))
    for f in ACTIONS_TEXT])

USERS = _schema(
    ("user_id", _LONG), ("username", _TEXT), ("name", _TEXT), ("age", IntegerType()),
    ("professional", _TEXT), ("city", _TEXT), ("sex", _TEXT))

PRODUCTS = _schema(("product_id", _LONG), ("product_name", _TEXT), ("extend_info", _TEXT))

CITIES = _schema(("city_id", _LONG), ("city_name", _TEXT), ("area", _TEXT))

# Ad clicks after parsing.
AD_CLICKS = _schema(
    ("click_time", TimestampType()), ("date", _DATE), ("province", _TEXT), ("city", _TEXT),
    ("userid", _LONG), ("adid", _LONG))

# Result tables of the ad stream.
AD_BLACKLIST = _schema(("userid", _LONG))
AD_USER_CLICK_COUNT = _schema(
    ("date", _DATE), ("userid", _LONG), ("adid", _LONG), ("clickCount", _LONG))
AD_STAT = _schema(
    ("date", _DATE), ("province", _TEXT), ("city", _TEXT), ("adid", _LONG),
    ("clickCount", _LONG))
AD_PROVINCE_COUNT = _schema(
    ("date", _DATE), ("province", _TEXT), ("adid", _LONG), ("clickCount", _LONG))
AD_PROVINCE_TOP3 = AD_PROVINCE_COUNT
# By the instant at which a minute starts; two minutes can have one name when clocks are set back.
AD_MINUTE_COUNT = _schema(
    ("date", _DATE), ("minute_start", TimestampType()), ("adid", _LONG), ("clickCount", _LONG))
