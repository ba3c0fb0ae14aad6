"""corpusgate: corpus audit, script projection and provenance jobs on Spark DataFrames."""

__version__ = "0.1.0"
