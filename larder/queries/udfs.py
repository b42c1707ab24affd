"""User-defined functions, each checked against the built-in form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import GRADE_NULL, PRICE_STEPS, RATING_REST
from ..functions.udfs import create_sql_ladder, label_function, log_score_batches, register_sql_function, row_udf
from .registry import PRICE_LABEL, RESTAURANTS, query, restaurants

_LABELLED = f"""
WITH {RESTAURANTS}, dirty AS (SELECT restaurant_id, NULLIF(average_rating, 950.0) AS average_rating FROM restaurants)
SELECT restaurant_id, CASE WHEN average_rating IS NULL THEN 'Sem Avaliacao' ELSE {PRICE_LABEL} END AS label FROM dirty"""


def _dirty(spark, sf_dir):
    rating = F.nullif(F.col("average_rating"), F.lit(950.0))
    return restaurants(spark, sf_dir).select("restaurant_id", rating.alias("average_rating"))


@query("udf_scalar", _LABELLED)
def udf_scalar(spark, sf_dir):
    label = row_udf(label_function(PRICE_STEPS, RATING_REST, GRADE_NULL), "string")
    return _dirty(spark, sf_dir).select("restaurant_id", label("average_rating").alias("label"))


@query("udf_sql", _LABELLED)
def udf_sql(spark, sf_dir):
    name = register_sql_function(
        spark, "rating_category", label_function(PRICE_STEPS, RATING_REST, GRADE_NULL), "string"
    )
    return spark.sql(
        f"SELECT restaurant_id, {name}(average_rating) AS label FROM {{rated}}", rated=_dirty(spark, sf_dir)
    )


@query("udf_sql_inlined", f"""
WITH {RESTAURANTS}
SELECT label, COUNT(*) AS total FROM (SELECT {PRICE_LABEL} AS label FROM restaurants) GROUP BY label""")
def udf_sql_inlined(spark, sf_dir):
    name = create_sql_ladder(spark, "rating_label", PRICE_STEPS, RATING_REST)
    return spark.sql(
        f"SELECT {name}(average_rating) AS label, COUNT(*) AS total FROM {{places}} GROUP BY 1",
        places=restaurants(spark, sf_dir),
    )


@query("udf_pandas", f"""
WITH {RESTAURANTS}
SELECT restaurant_id, ROUND(average_rating * average_rating * LN(1 + monthly_orders) / 10, 3) AS score
FROM restaurants""")
def udf_pandas(spark, sf_dir):
    score = log_score_batches()(F.col("average_rating"), F.col("monthly_orders").cast("double"))
    return restaurants(spark, sf_dir).select("restaurant_id", F.round(score, 3).alias("score"))
