"""Operators: rules, staging, segments, metrics, checks, duplicates, profiles, and relational shapes over DataFrames."""
