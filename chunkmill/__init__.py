"""Spark-native chunking, enrichment, embedding and incremental indexing of structured legal documents."""
