"""crateflow: a Spark-native engine for cleaning, linking and rolling up release catalogues."""

from crateflow.session import get_spark

__all__ = ["get_spark"]
