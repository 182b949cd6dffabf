"""Document-knowledge analytics expressed as Spark DataFrame plans."""

from lodestack.session import get_session

__all__ = ["get_session"]
