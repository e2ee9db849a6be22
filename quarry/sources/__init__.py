"""Sources: the driver's parquet tables, derived fixtures, and file sinks."""
