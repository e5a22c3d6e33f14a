"""Writing tables and per-dataset exports."""
