"""mercato: marketplace and review analytics as Spark DataFrame operators.

Subpackages
-----------
sources    reading raw tables and review files, profiling, typing, sinks
functions  column expressions (dates, derived measures, text, statistic tails)
operators  reusable DataFrame operators (quality checks, ranks, joins, stats, sentiment)
plans      the study's logical plans: fact model, named queries, measures, hypotheses
streaming  Structured Streaming versions of the review operators
"""

__version__ = "0.1.0"
