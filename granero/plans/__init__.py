"""The mart's flows, from source tables to target rows."""
