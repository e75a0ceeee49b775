"""Recommendation and behaviour analytics as Spark jobs.

``sources``    reading and writing tables, files and streams
``functions``  column functions
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole jobs, serving queries and the registered query set
``streaming``  Structured Streaming forms of the event operators
"""

__version__ = "0.1.0"
