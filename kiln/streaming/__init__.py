from kiln.streaming.bronze_ingest import ingest_landing, read_bronze  # noqa: F401
