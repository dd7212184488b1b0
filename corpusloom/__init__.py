"""A Spark-native engine for preparing language-model training data."""
