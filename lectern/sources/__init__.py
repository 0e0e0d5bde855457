"""Scans. Schemas are declared, nothing is inferred from the data."""
