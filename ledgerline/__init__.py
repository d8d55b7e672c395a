"""Incremental order warehouse on Spark.

Raw text extracts are landed as all-string tables, cleaned into typed staging
entities, and published as customer / product / seller dimensions, an
order-item fact, an order fact and a denormalised serving table. Every step is
a DataFrame plan; the driver only holds table pointers, batch bounds and
counters.
"""

__all__ = ["session", "schemas"]
