"""Readers. Each `read_*` has a `parse_*` twin for lines that are already a DataFrame."""
