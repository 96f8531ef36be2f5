"""folioframe: a PySpark-native engine for document structure and text-corpus quality."""
