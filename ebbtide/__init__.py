"""Ebbtide: a PySpark-native engine that decides how long a short-term job posting stays valid."""

__version__ = "0.1.0"
