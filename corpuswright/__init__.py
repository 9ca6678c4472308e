"""A Spark-native engine for curating text corpora."""
