"""Spark-native operators for image-based spatial transcriptomics tables."""
