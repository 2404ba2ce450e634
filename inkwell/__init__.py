"""Inkwell: web and subscription analytics for publishers, written as Spark DataFrame plans."""

from inkwell.config import EngineConfig, Parameter

__all__ = ["EngineConfig", "Parameter"]
