"""Tabular risk scoring on Spark: prepare, train, evaluate and score whole tables."""
