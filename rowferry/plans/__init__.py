"""State tables, decisions and whole runs."""
