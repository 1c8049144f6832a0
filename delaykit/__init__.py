"""Delay analytics on Spark DataFrames.

Operators take DataFrames and parameters and give back DataFrames, so they
compose with ``DataFrame.transform`` and run the same on batch and streaming
input wherever they are row-local.
"""

__version__ = "0.1.0"
