"""Reading: tables, snapshots, databases, staged tables."""
