"""Sources and sinks: explicit schemas, CSV ingestion, layer tables, the driver's star schema."""
