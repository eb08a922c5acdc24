"""A PySpark-native analytics engine for curated event catalogues."""
