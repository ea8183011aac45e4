"""Layered analytics on public business-entity registers, written for Spark."""

__version__ = "0.1.0"
