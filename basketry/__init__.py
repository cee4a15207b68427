"""basketry: retail basket analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or a small Python
value computed on the cluster).  Raw transactions are cleaned and
exploded into a typed ``sales`` fact (one row per unit sold); the rest of
the library answers questions over that fact: KPIs, rankings, time
series, purchase gaps, Pareto, segments, K-Means, itemsets, association
rules and recommendations, in batch and incrementally.
"""

__version__ = "0.1.0"
