"""Statistics, similarity, factor models and scoring as DataFrame operators."""
