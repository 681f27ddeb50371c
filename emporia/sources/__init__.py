"""Sources and sinks: explicit schemas, CSV / Parquet scans, catalog
registration, load reports and the driver-table adapter."""
