"""PySpark-native analytics for large collections of short news-style articles."""
