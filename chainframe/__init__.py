"""chainframe: a PySpark-native engine for block-structured, reorganisable feeds."""
