"""Writers: partitioned tables, catalog entries, CSV exports."""
