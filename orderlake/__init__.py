"""Layered order data on Spark: ingest, typing, quality, history and reporting.

Everything in :mod:`orderlake.operators` is a plain ``DataFrame -> DataFrame``
function without actions.  :mod:`orderlake.sources` reads raw files and keeps
Parquet tables; :mod:`orderlake.plans` wires both into runnable batches.
"""

__version__ = "0.1.0"
