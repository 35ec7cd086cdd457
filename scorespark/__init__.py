"""scorespark: credit-risk scoring, evaluation and monitoring as Spark jobs."""

from scorespark.spec import DEFAULT_SPEC, FeatureSpec

__all__ = ["DEFAULT_SPEC", "FeatureSpec"]
