"""Union, connect, split and side outputs."""

from pyspark.sql import functions as F

from tidewater.functions.text import join_fields, rejoin_first_two
from tidewater.operators import routing
from tidewater.plans.catalogue import query
from tidewater.plans.inputs import numbered_events


def _actions(spark, sf_dir):
    return numbered_events(spark, sf_dir).select(
        "event_id", F.concat(F.lit("productID"), "k").alias("product"), F.col("event_type").alias("action"),
        F.concat(F.lit("user_"), "user_id").alias("user"))


_ACTIONS = """
    WITH actions AS (SELECT event_id, 'productID' || (props->>'k') AS product, event_type AS action,
                            'user_' || user_id AS "user" FROM events)
"""


@query(_ACTIONS + """
    SELECT * FROM actions WHERE action = 'click' UNION ALL SELECT * FROM actions WHERE action = 'view'
    UNION ALL SELECT * FROM actions
""")
def union_all(spark, sf_dir):
    actions = _actions(spark, sf_dir)
    return routing.union(actions.where("action = 'click'"), actions.where("action = 'view'"), actions)


@query(_ACTIONS + """
    SELECT product || ',' || action || ',' || "user" AS value FROM actions WHERE action <> 'view'
    UNION ALL SELECT product || '>>' || action FROM actions WHERE action = 'view'
""")
def connect_reformat(spark, sf_dir):
    actions = _actions(spark, sf_dir)
    tuples = actions.where("action <> 'view'")
    texts = actions.where("action = 'view'").select(F.concat_ws(":", "product", "action", "user").alias("text"))
    return routing.connect(tuples, texts, join_fields(",", F.col("product"), F.col("action"), F.col("user")),
                           rejoin_first_two(F.col("text")))


@query(_ACTIONS + "SELECT * FROM actions WHERE product = 'productID1'")
def split_select(spark, sf_dir):
    tagged = routing.tag(_actions(spark, sf_dir), {
        "productID1": F.col("product") == "productID1", "productID2": F.col("product") == "productID2"})
    return routing.select_output(tagged, "productID1")


def _side_outputs(spark, sf_dir):
    return routing.side_output(_actions(spark, sf_dir), F.col("action") != "click")


@query(_ACTIONS + "SELECT * FROM actions WHERE action = 'click'")
def side_output_main(spark, sf_dir):
    return _side_outputs(spark, sf_dir)[0]


@query(_ACTIONS + "SELECT * FROM actions WHERE action <> 'click'")
def side_output_side(spark, sf_dir):
    return _side_outputs(spark, sf_dir)[1]
