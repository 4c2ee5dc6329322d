"""Table sources: the driver's parquet tables, derived views, CSV and literal tables."""

from tessera.sources.tables import Tables, scan_parquet  # noqa: F401
