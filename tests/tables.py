"""Small hand-made input tables."""

import datetime as dt

from pyspark.sql.functions import to_date

from clickloom import TaskParams, schemas
from clickloom.sources.tables import actions_from_text

START = dt.datetime(2024, 1, 10, 8, 0, 0)
PARAMS = TaskParams.of("2024-01-01", "2024-01-31")


def at(seconds):
    return (START + dt.timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def action(session="s1", seconds=0, page=1, user=1, time=None, **values):
    time = time or at(seconds)
    row = {name: None for name in schemas.ACTIONS_TEXT.names}
    row |= {"date": time[:10], "user_id": user, "session_id": session, "page_id": page,
            "action_time": time, "click_category_id": -1, "click_product_id": -1, "city_id": 0}
    return row | values


def actions(spark, *rows):
    data = [tuple(row[name] for name in schemas.ACTIONS_TEXT.names) for row in rows]
    return actions_from_text(spark.createDataFrame(data, schemas.ACTIONS_TEXT))


def users(spark, *rows):
    """Rows of (user_id, age, professional, city, sex)."""
    data = [(user, f"user{user}", f"name{user}", age, professional, city, sex)
            for user, age, professional, city, sex in rows]
    return spark.createDataFrame(data, schemas.USERS)


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def click(day, user=1, ad=1, province="0", second=0):
    moment = dt.datetime(2024, 1, day, 12, tzinfo=dt.timezone.utc).timestamp() + second
    return f"{int(moment * 1000)} {province} {province} {user} {ad}"


def rows(df, *columns, order=True):
    found = [tuple(row) for row in df.select(*columns or df.columns).collect()]
    return sorted(found, key=str) if order else found


def texted(df):
    """With the day as text."""
    return df.withColumn("date", to_date("date").cast("string"))
