"""tidemark: a Spark-native customer-data pipeline.

Raw customer, order and journey tables become keyed, incrementally
maintained marts (identity map, id registry, shop links, customer
profile, orders, journeys). Every step is a DataFrame transformation;
the only actions are the snapshot writes in :mod:`tidemark.plans.sync`.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
