"""Ordered-ledger analytics on PySpark: decode logs, fold state, look it up, value it, audit it."""
