"""Whole queries: medallion layers, fleet KPIs, the risk model and SQL views."""
