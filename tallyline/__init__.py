"""tallyline: sales data-quality ETL and analytics as Spark DataFrame plans."""

__version__ = "0.1.0"
