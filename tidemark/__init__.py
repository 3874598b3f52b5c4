"""tidemark: quality-lakehouse operators written as ordinary Spark DataFrame transformations."""

from tidemark.session import build_session, workdir

__all__ = ["build_session", "workdir"]
__version__ = "0.1.0"
