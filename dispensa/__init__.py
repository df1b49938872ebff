"""Reconciliation of dirty delivery records against contract, catalog and price lists on Spark."""
