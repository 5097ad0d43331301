"""The relational core as SQL functions and views, for those who work in SQL cells.

``register`` defines, for the session, scalar functions for cleaning, scoring and refinement and table functions over
the views that ``create_views`` makes. They are SQL functions, so Catalyst inlines their bodies: no Python runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from supplyloom.functions.names import legal_form_pattern
from supplyloom.operators.refine import MIN_CONFIDENCE, REVIEW_CONFIDENCE, REVIEW_PREDICTION
from supplyloom.storage import stored

RELATIONS, COMPANIES = "loom_relations", "loom_companies"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


SCALARS = {
    "loom_company_name(name STRING) RETURNS STRING": f"regexp_replace(trim(name), {_text(legal_form_pattern())}, '$1')",
    "loom_sigmoid(x DOUBLE) RETURNS DOUBLE": "1D / (1D + exp(-x))",
    "loom_dot(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": (
        "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (total, p) -> total + p)"
    ),
    "loom_link_score(as_buyer DOUBLE, as_seller DOUBLE, bias DOUBLE) RETURNS DOUBLE": "1D / (1D + exp(-(as_buyer + as_seller + bias)))",
    "loom_refined(prediction DOUBLE, probability DOUBLE) RETURNS DOUBLE": (
        "CASE WHEN prediction >= probability THEN prediction ELSE probability END"
    ),
}

TABLES = {
    "loom_silver(least DOUBLE DEFAULT {confidence}) RETURNS TABLE "
    "(eid BIGINT, src_id BIGINT, dst_id BIGINT, Purchaser STRING, Seller STRING, probability DOUBLE)": """
        SELECT eid, src_id, dst_id, loom_company_name(Purchaser), loom_company_name(Seller), probability
        FROM {relations} WHERE probability >= least""",
    "loom_predictions(bias DOUBLE) RETURNS TABLE "
    "(eid BIGINT, src_id BIGINT, dst_id BIGINT, Purchaser STRING, Seller STRING, probability DOUBLE, gnn_prediction DOUBLE)": """
        SELECT s.eid, s.src_id, s.dst_id, s.Purchaser, s.Seller, s.probability, loom_link_score(u.as_buyer, v.as_seller, bias)
        FROM loom_silver() s LEFT JOIN {companies} u ON u.id = s.src_id LEFT JOIN {companies} v ON v.id = s.dst_id""",
    "loom_review(bias DOUBLE, min_prediction DOUBLE DEFAULT {prediction}, max_probability DOUBLE DEFAULT {probability}) "
    "RETURNS TABLE (Purchaser STRING, Seller STRING, probability DOUBLE, gnn_prediction DOUBLE)": """
        SELECT p.Purchaser, p.Seller, p.probability, p.gnn_prediction FROM loom_predictions(bias) p
        WHERE p.gnn_prediction > p.probability AND p.gnn_prediction > min_prediction AND p.probability < max_probability""",
}


def create_views(spark: SparkSession, relations: DataFrame, companies: DataFrame) -> None:
    """``relations`` as they come, and ``companies`` (id, as_buyer, as_seller), the model's view of each company."""
    relations.createOrReplaceTempView(RELATIONS)
    stored(companies, "companies").createOrReplaceTempView(COMPANIES)


def register(spark: SparkSession) -> None:
    """Defines the functions; table functions need the views to be there."""
    names = {
        "relations": RELATIONS, "companies": COMPANIES, "confidence": f"{MIN_CONFIDENCE}D",
        "prediction": f"{REVIEW_PREDICTION}D", "probability": f"{REVIEW_CONFIDENCE}D",
    }
    for signature, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    for signature, body in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature.format(**names)} RETURN {body.format(**names)}")
