"""Labelled-text quality, splitting, features and evaluation as Spark DataFrame jobs."""

from labelloom.roles import Roles

__all__ = ["Roles"]
