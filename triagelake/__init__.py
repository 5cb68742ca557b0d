"""Log-to-incident analytics as DataFrame-to-DataFrame functions on Spark SQL."""

__version__ = "0.1.0"
