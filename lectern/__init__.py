"""Learning analytics over enrolment-style fact tables, on Spark DataFrames.

``functions``  column expressions
``operators``  DataFrame -> DataFrame building blocks that take column names
``sources``    scans (delimited text, ORC, tables, JDBC)
``sinks``      writers (tables, delimited exports, JDBC)
``plans``      the domain: cleaning, layers, marts, risk, profiles, sync
``catalog``    the registered queries and their SQL equivalents
"""
