"""Cleansing, deduplication and profiling of tabular data as Spark jobs.

``functions``  column expressions (parsing, number test, column names)
``operators``  DataFrame -> DataFrame steps (rules, dedup, profiling, quality)
``sources``    CSV directories and file listings
``sinks``      Parquet and CSV outputs
``plans``      the two composite jobs, built from the above
``catalogue``  ready-made queries over the test tables, with their SQL twins
"""
