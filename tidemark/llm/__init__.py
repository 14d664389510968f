"""Operators for large training-data pipelines. Nothing else in the library imports this
subpackage; the driver entry adds its queries when it can be imported."""
