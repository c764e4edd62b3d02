"""carepath: Spark-native readmission and length-of-stay analytics."""

__version__ = "0.1.0"
