"""SQL functions for users who query the tables with SQL text.

They are SQL functions, not Python ones: Catalyst inlines their bodies into the calling query.
For the distinct, joined list of a group use the built-in
``listagg(distinct x, ',') within group (order by x)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# The names under which users know these functions.
_FUNCTIONS = {
    "concat_long_string(id bigint, label string, sep string)":
        "concat(cast(id as string), sep, label)",
    "get_json_field(json string, field string)":
        "get_json_object(json, concat('$.', field))",
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {signature} returns string return {body}")
