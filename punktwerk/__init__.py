"""punktwerk: point-cloud and vector-shape analytics on Spark DataFrames.

Everything is expressed with the DataFrame / SQL API so that Catalyst plans
it: geometry predicates are Column expressions, spatial joins are grid-cell
equi-joins, clustering is an iterative join/aggregate loop.
"""

__version__ = "0.1.0"
