"""Data-analysis operators as Spark DataFrame functions.

DataFrame in, DataFrame out; no function here creates a session. See README.md for the map of modules.
"""
