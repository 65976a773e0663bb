"""Warehouse-logistics analytics written as PySpark DataFrame plans."""
