"""Spark-native screening of transmission constraints.

Every operator is a function from DataFrames (and small settings) to a lazy DataFrame.
Actions happen only in validations, in graph loops and in sinks.
"""
