"""Landing of raw files, stored tables, and exports."""
