"""Spark-native building, checking and watching of a news-article corpus."""
