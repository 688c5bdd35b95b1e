"""Pickup-spot mining as Spark DataFrame plans."""
