"""Sources and sinks: raw CSV ingest, the benchmark-table mapping, layer writes."""
