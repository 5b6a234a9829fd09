"""Sources and sinks: raw CSV, processed Parquet, mart extracts, the bridge."""
