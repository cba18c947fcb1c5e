"""Operators for preparing large text corpora, each as a Spark job over whole tables."""
