"""framegate: checks, preparation, scoring and monitoring of labelled tables on Spark."""

__version__ = "0.1.0"
