"""A Spark-native engine for auditing text corpora and building training data."""
