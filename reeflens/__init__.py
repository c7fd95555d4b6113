"""reeflens: reef-survey trend analytics as Spark DataFrame pipelines."""

__version__ = "0.1.0"
