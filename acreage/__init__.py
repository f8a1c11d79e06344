"""Spark-native raster/vector field-delineation analytics."""
