"""Revision-aware event warehouse and analytics operators on PySpark."""
