"""Reading extracts and lookups, writing snapshots."""
