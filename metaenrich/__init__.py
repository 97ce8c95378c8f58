"""PySpark-native enrichment of scholarly-metadata records."""
