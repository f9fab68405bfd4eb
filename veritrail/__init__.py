"""Spark-native provenance, corpus and evidence-graph analytics."""
