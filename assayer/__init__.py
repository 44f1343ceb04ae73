"""assayer: a PySpark engine that curates labelled corpora and judges calibrated decision data."""

__version__ = "0.1.0"
