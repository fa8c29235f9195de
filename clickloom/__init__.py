"""clickloom: product analytics over clickstream events, as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Only
``clickloom.sources`` and ``clickloom.plans.stages`` write anything.
"""

__version__ = "0.1.0"
