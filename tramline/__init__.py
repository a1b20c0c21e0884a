"""tramline: transit-operations analytics as ordinary Spark DataFrame jobs.

Every operator is a function from DataFrames and column names to a DataFrame.
Nothing in the operator modules runs a Spark action; the few jobs that must
write (sinks, streaming state, lineage cuts) say so in their names.
"""
