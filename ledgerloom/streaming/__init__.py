from ledgerloom.streaming.ingest import ingest_monthly_drops, newest_file_per_period  # noqa: F401
