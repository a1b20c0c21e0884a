"""Writing tables, extracts, snapshots and views. These functions run jobs."""
