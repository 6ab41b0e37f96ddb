"""Encounter analytics on Spark: cohort, features, segment KPIs, statistics, models, metrics, exports."""
