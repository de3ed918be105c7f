"""Whole runs, the warehouse, exports, and the queries by name."""
