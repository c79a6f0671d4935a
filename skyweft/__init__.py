"""PySpark-native analytics for multi-sensor aircraft surveillance data."""
