"""A Spark-native engine for preparing and auditing text corpora."""
