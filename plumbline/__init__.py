"""A validated KPI engine on Spark: rules, bounds and verdicts over months of records, and operators for text corpora."""
