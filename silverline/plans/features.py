"""Rule-based 0/1 recommendation features of a product row: one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions import fixed, text as t
from silverline.operators.columns import ensure_columns

COPIED = {"fungal_acne_safe": "fungal_acne_safe", "pregnancy_safe": "pregnancy_safe",
          "comedogenic_risk": "comedogenic_rating", "irritation_risk": "irritation_rating"}


def feature_columns(text: Column) -> dict[str, Column]:
    """The features that need the text. A good score or a word gives 1."""
    out = {}
    for name, (score, words) in fixed.FEATURE_RULES.items():
        hit = t.contains_any(text, words)
        if score:
            hit = hit | (F.coalesce(F.col(score), F.lit(0)) >= fixed.GOOD_SCORE)
        out[name] = hit.cast("int")
    out["avoid_for_sensitive"] = (
        t.contains_any(text, fixed.AVOID_SENSITIVE_WORDS)
        & ~t.contains_any(text, fixed.AVOID_SENSITIVE_EXCEPT)).cast("int")
    return out


def recommendation_features(products: DataFrame) -> DataFrame:
    scores = sorted({s for s, _ in fixed.FEATURE_RULES.values() if s})
    df = ensure_columns(products, fixed.FEATURE_TEXT_FIELDS)
    df = ensure_columns(df, scores + list(COPIED.values()), "int")
    df = df.withColumn("_text", F.lower(t.safe_concat(fixed.FEATURE_TEXT_FIELDS)))
    return df.select(
        "product_id",
        *[c.alias(n) for n, c in feature_columns(F.col("_text")).items()],
        (F.col("fungal_acne_safe") == 0).cast("int").alias("avoid_for_fungal_acne"),
        *[F.col(source).alias(n) for n, source in COPIED.items()])
