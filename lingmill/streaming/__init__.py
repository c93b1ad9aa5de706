"""The row-by-row parts on arriving files."""
