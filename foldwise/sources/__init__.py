"""Scans and sinks: CSV / parquet, feature sets, predictions, feature lists, word vectors."""
