"""pricelens: price-snapshot analytics as Spark DataFrame plans.

Landed catalog pages are parsed and validated into an append-only snapshot
table, from which a cleaned staging dataset and the marts (price history,
movers, category summary, daily deals), latest-price views, quality checks
and analyst reports are derived.
"""

__version__ = "0.1.0"
