"""tidemark: point-in-time analytics and training-data operators on PySpark."""

from tidemark.session import get_spark, shared_dir, table

__all__ = ["get_spark", "shared_dir", "table"]
