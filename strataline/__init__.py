"""Spark-native analytics over tracked boxes, identity crops, embeddings and text corpora."""
