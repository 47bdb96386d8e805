"""Writers: partitioned tables, upserts, range replacement, CSV exports, run log."""
