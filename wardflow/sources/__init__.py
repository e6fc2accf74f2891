"""Files, register pages and messages as DataFrames."""
