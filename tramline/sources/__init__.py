"""Reading feeds, schedules, tables and file manifests."""
