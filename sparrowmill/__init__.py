"""PySpark-native analytics engine for semi-structured public documents."""
