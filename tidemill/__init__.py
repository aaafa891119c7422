"""Warehouse analytics operators for retail, logistics and user-behaviour data on Spark."""

__version__ = "0.1.0"
