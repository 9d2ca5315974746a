"""Registered checks: store tables derived from the driver's tables, queries and their SQL."""
