"""Writers for snapshots, keyed tables, marks and records."""
