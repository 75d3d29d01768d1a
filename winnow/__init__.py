"""winnow: listing acquisition and triage as Spark DataFrame operators."""

__version__ = "0.1.0"
