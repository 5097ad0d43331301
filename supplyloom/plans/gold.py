"""From silver relations and a model to the refined gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from supplyloom.operators.features import normal_features
from supplyloom.operators.graph import edges_of, node_set
from supplyloom.operators.refine import refine_confidence, review_links
from supplyloom.operators.sage import LinkModel, endpoint_scores
from supplyloom.operators.scoring import score_relations
from supplyloom.plans.training import full_embeddings
from supplyloom.storage import materialise


@dataclass(frozen=True)
class Gold:
    predictions: DataFrame
    review: DataFrame
    refined: DataFrame


def company_scores(
    edges: DataFrame, model: LinkModel, features: DataFrame | None = None, seed: int = 0, final_relu: bool = False
) -> DataFrame:
    """Written table ``(id, as_buyer, as_seller)``: the model's view of every company."""
    if features is None:
        features = normal_features(node_set(edges), model.layer1.width_in, seed)
    embeddings = full_embeddings(edges, features, model, final_relu)
    return materialise(endpoint_scores(embeddings, model), "companies")


def build_gold(silver: DataFrame, model: LinkModel, features: DataFrame | None = None, seed: int = 0) -> Gold:
    """Scores every relation once; the result frames read the written prediction table."""
    companies = company_scores(edges_of(silver), model, features, seed)
    predictions = materialise(score_relations(silver, companies, model.score_b), "predictions")
    return Gold(predictions, review_links(predictions), refine_confidence(predictions))


def write_gold(gold: Gold, predictions_table: str, refined_table: str) -> None:
    gold.predictions.write.mode("overwrite").saveAsTable(predictions_table)
    gold.refined.write.mode("overwrite").saveAsTable(refined_table)
