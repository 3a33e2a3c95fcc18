"""Clinical-delivery harmonization as Spark DataFrame transformations."""

__version__ = "0.1.0"
