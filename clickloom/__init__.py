"""Clickstream and ad-click analytics as PySpark DataFrame operators."""

from clickloom.params import TaskParams
from clickloom.session import build_session

__all__ = ["TaskParams", "build_session"]
