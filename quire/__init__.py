"""quire -- corpus cleaning, scoring and mapping as Spark DataFrame jobs."""

__version__ = "0.1.0"
