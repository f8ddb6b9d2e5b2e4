"""Reading raw files, publishing tables, exporting rows."""
