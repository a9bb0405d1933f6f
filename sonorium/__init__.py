"""A Spark-native engine for building and auditing speech corpora."""
