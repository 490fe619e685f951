"""Sinks: parquet marts (flat, partitioned, versioned), CSV reports, tables, quarantine."""
