"""Docketloom: a PySpark-native analytics engine for case files and their docket histories."""
