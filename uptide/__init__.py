"""Prescriptive-maintenance analytics expressed as Spark DataFrame transformations."""
