"""Spark-native toolkit: ingest, load, classify and group texts into topics.

Every operator is a plain function over DataFrames, to be used on its own or
through ``DataFrame.transform``.
"""
