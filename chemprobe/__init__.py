"""Spark-native engine for chemical-probing (mutational profiling) sequencing data."""
