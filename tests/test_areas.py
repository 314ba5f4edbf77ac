from clickloom import schemas
from clickloom.operators import areas
from clickloom.plans import jobs
from clickloom.sources import tables
from tests.tables import PARAMS, action, actions, rows


def _cities(spark):
    return spark.createDataFrame(
        [(1, "X", "华北"), (11, "X", "华北"), (3, "Y", "东北")], schemas.CITIES)


def _products(spark, *ids):
    return spark.createDataFrame(
        [(i, f"p{i}", '{"product_status": %d}' % (i % 2)) for i in ids], schemas.PRODUCTS)


def _clicks(spark, *pairs):
    acts = actions(spark, *[action(city_id=c, click_product_id=p) for c, p in pairs])
    return tables.product_clicks_in_range(acts, PARAMS)


def test_city_list_keeps_a_city_whose_text_is_part_of_another(spark):
    clicks = _clicks(spark, (11, 7), (1, 7), (1, 7), (3, 7), (99, 7))
    assert rows(areas.area_product_counts(clicks, _cities(spark))) == [
        ("东北", 7, 1, "3:Y"), ("华北", 7, 3, "1:X,11:X")]
    assert areas.area_clicks(clicks, _cities(spark)).count() == 4


def test_top3_with_ties_and_unknown_products(spark):
    clicks = [(1, p) for p in (5, 4, 3, 2, 9, 9, 9)] + [(3, 2)]
    acts = actions(spark, *[action(city_id=c, click_product_id=p) for c, p in clicks])
    found = jobs.area_job(acts, _products(spark, 2, 3, 4, 5), _cities(spark), PARAMS)
    assert rows(found["area_top3_product"]) == [
        ("task", "东北", "D Level", 2, "3:Y", 1, "p2", "self"),
        ("task", "华北", "A Level", 2, "1:X", 1, "p2", "self"),
        ("task", "华北", "A Level", 3, "1:X", 1, "p3", "others"),
        ("task", "华北", "A Level", 4, "1:X", 1, "p4", "self")]


def test_rank_is_cut_before_the_shuffle(spark):
    acts = actions(spark, action(click_product_id=1))
    found = jobs.area_job(acts, _products(spark, 1), _cities(spark), PARAMS)
    plan = found["area_top3_product"]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
