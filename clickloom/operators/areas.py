"""Most clicked products of every sales area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import columns as C

TOP_PRODUCTS = 3


def area_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Every product click with its city and area; clicks of unknown cities are left out."""
    return (clicks.withColumnRenamed("click_product_id", "product_id")
            .join(cities, "city_id", "inner")
            .select("city_id", "city_name", "area", "product_id"))


def area_product_counts(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per area and product, with the cities they came from.

    Clicks are first counted per city and product, in a plain hash aggregate with a map-side part.
    The join with the cities and the city lists then work on one row per city and product, however
    many clicks one product drew and however large the city table is.
    """
    per_city = (clicks.groupBy("city_id", F.col("click_product_id").alias("product_id"))
                .agg(F.count(F.lit(1)).alias("clicks")))
    return (per_city.join(cities, "city_id", "inner")
            .groupBy("area", "product_id")
            .agg(F.sum("clicks").alias("click_count"),
                 C.city_list(F.col("city_id"), F.col("city_name")).alias("city_infos")))


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Area counts with the product's name and seller; unknown products are left out."""
    info = products.select("product_id", "product_name",
                           C.product_status(F.col("extend_info")).alias("product_status"))
    return (counts.join(info, "product_id", "inner")
            .select("area", "city_infos", "product_id", "product_name", "product_status",
                    "click_count"))


def area_top3_products(info: DataFrame, task_id: str, top: int = TOP_PRODUCTS) -> DataFrame:
    """The most clicked products per area; equal counts by smallest product id."""
    by_area = Window.partitionBy("area").orderBy(F.desc("click_count"), "product_id")
    return (info.withColumn("place", F.row_number().over(by_area))
            .where(F.col("place") <= top)
            .select(F.lit(task_id).alias("taskid"), "area",
                    C.area_level(F.col("area")).alias("areaLevel"),
                    F.col("product_id").alias("productid"),
                    F.col("city_infos").alias("cityInfos"),
                    F.col("click_count").alias("clickCount"),
                    F.col("product_name").alias("productName"),
                    F.col("product_status").alias("productStatus")))
