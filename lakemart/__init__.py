"""Layered warehouse and profit-and-loss mart on Spark DataFrames.

``sources``    reads and writes tables: JDBC, dated partitions, staging, seeds, run log
``operators``  works on any DataFrame: newest row, upsert, history, checks, monitoring
``functions``  column expressions shared by everything above
``plans``      the mart itself: calendar, dimensions, facts, reports, metrics, cards
``streaming``  file-stream intake into a keyed table
``catalog``    every query on the bundled test tables, with its SQL twin
"""
