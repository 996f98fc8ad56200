"""quern: a PySpark-native engine for page-oriented text, matching and incremental delivery."""
