"""Paddock: recommendation features, samples and evaluation as Spark jobs.

Everything is a plain function from DataFrames to a DataFrame.  Nothing is
collected beyond model-sized scalars, no group of unbounded size meets in one
task, and every shuffle key that the data may make hot is split first.
"""

__version__ = "0.1.0"
