"""Tidemark: a medallion pipeline for transaction events, written as Spark DataFrame jobs.

Layers
------
``functions``   pure Column expressions (event time, masking, hour keys, risk rules)
``operators``   ``DataFrame -> DataFrame`` steps; they run on batch and stream alike
``sources``     readers and writers for the contract, the tables and the test view
``streaming``   the two streaming queries that feed Bronze and Silver
``plans``       jobs built from the above: Gold builds, the driver's query catalogue
"""
