"""Basket analytics and recommendations as Spark jobs."""
