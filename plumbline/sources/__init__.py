"""Reading and writing: snapshots, contracts, history tables, published reports."""
