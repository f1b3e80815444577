"""Rental analytics warehouse written as PySpark DataFrame functions."""
