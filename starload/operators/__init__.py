"""Generic DataFrame operators of the warehouse load (joins, keys, loads, reports, checks)."""
