"""Spark-native engine that turns image-annotation collections into instruction conversations."""
