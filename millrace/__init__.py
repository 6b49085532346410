"""A Spark-native analytics engine for large collections of news-like documents."""
