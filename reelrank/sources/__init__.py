"""Table readers, derived rating/item tables, file sinks and sources."""
