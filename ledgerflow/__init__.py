"""A PySpark engine for transaction-consistent change data."""
