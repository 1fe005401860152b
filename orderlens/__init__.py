"""Supply-chain and sales analytics as Spark jobs.

Raw order-line files become a typed staging layer, a fact table, four marts,
a family of filtered exploration queries and a scored data-quality report.
"""

__version__ = "0.1.0"
