"""Sources and sinks: CSV/Parquet/JSON scans with declared schemas, defaults,
persisted stage tables and fitted statistics."""
