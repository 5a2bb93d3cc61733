"""Column expressions shared by the operators; no jobs are run here."""
