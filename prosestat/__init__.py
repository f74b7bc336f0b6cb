"""Corpus text analytics as Spark DataFrame jobs.

``functions``  Column builders (text, body markers, numbers, paths, JSON lines)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame transformations
``plans``      whole-corpus run and the registered queries
"""
