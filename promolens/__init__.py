"""promolens: retail promotion analytics written as ordinary Spark jobs."""

__version__ = "0.1.0"
