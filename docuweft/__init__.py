"""Operational tables of many tenants as one searchable document table, on Spark."""
