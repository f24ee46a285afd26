"""scoreloop: the data side of a text-scoring feedback loop, on Spark.

Ingest feedback, gate it, validate it, audit and split training sets, score
texts in bulk, measure models and analyse training runs -- all as DataFrame
plans that Catalyst and AQE can optimise.
"""

__version__ = "0.1.0"
