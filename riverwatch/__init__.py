"""riverwatch: flood-risk analytics for weather readings on Spark.

Batch, stream and serving paths share one set of DataFrame functions:
``sources`` produce DataFrames, ``functions`` build Column expressions,
``operators`` are DataFrame -> DataFrame transforms, ``sinks`` write,
``plans`` wire operators into the batch and serving jobs and
``streaming`` holds the Structured Streaming jobs.
"""

__version__ = "0.1.0"
