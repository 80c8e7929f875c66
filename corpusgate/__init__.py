"""corpusgate: record-integrity and corpus-analytics operators on PySpark DataFrames."""

from corpusgate.session import checkpoint_dir, durable, get_session

__all__ = ["checkpoint_dir", "durable", "get_session"]
