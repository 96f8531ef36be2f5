"""Sources (Parquet tables, documents, line records, word boxes, texts, page files) and sinks."""
