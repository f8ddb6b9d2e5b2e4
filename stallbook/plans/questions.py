"""The analytics questions by name, over the published tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.operators import analytics as a
from stallbook.operators import search
from stallbook.operators.matching import with_partner

Question = Callable[[Mapping[str, DataFrame]], DataFrame]

QUESTIONS: dict[str, Question] = {
    "late_deliveries": lambda t: a.late_deliveries(t["orders"], t["customers"], t["order_items"], t["products"]),
    "never_ordered": lambda t: a.never_ordered(t["products"], t["order_items"]),
    "monthly_revenue": lambda t: a.monthly_revenue(t["orders"], t["payments"]),
    "category_scores": lambda t: a.category_scores(t["order_items"], t["products"], t["order_reviews"]),
    "seller_ranks": lambda t: a.seller_ranks(t["sellers"], t["order_items"]),
    "running_spend": lambda t: a.running_spend(t["orders"], t["customers"], t["payments"]),
    "top_products": lambda t: a.top_products(t["order_items"], t["products"]),
    "churned": lambda t: a.churned(t["orders"], t["customers"]),
    "top_categories": lambda t: a.top_categories(t["order_items"], t["orders"], t["products"]),
    "monthly_top_category": lambda t: a.monthly_top_category(t["order_items"], t["orders"], t["products"]),
    "cut_line_band": lambda t: a.cut_line_band(t["order_items"], t["orders"], t["sellers"]),
    "repeat_share": lambda t: a.repeat_share(t["orders"], t["customers"], t["payments"]),
    "delay_vs_score": lambda t: a.delay_vs_score(t["orders"], t["order_reviews"]),
}


def nearest_reviews(reviews: DataFrame, vectors: DataFrame, seed_order: str,
                    k: int = 5, metric: str = "cosine") -> DataFrame:
    """The reviews most like the one of ``seed_order``; the seed comes first.

    The vectors are searched alone; only the ``k`` found fetch their text.
    """
    found = search.nearest(with_partner(vectors, reviews, "order_id"), seed_order, k, metric)
    texts = reviews.select("order_id", "review_id", "review_comment_message")
    return (texts.join(F.broadcast(found.select("order_id", "distance")), "order_id")
            .orderBy("distance", "order_id").select("review_id", "review_comment_message"))
