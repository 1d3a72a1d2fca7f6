"""Retail price data on PySpark: every input row lands, and every row is accounted for."""
