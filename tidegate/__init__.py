"""Spark-first processing of cyclical operational feeds.

Files arrive per day and reporting cycle; they end up clean, checked and keyed
in one table.  Everything is a function over DataFrames or Columns, so a whole
load is one logical plan that Catalyst can optimise.
"""

__version__ = "0.1.0"
