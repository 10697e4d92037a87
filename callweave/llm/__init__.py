"""Training-data operators: each takes and returns DataFrames; catalog.py registers their queries."""
