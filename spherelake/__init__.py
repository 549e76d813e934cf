"""Sphere-grid analytics on Spark: regridding, pyramids, stores, all as DataFrame plans."""
