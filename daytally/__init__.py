"""Star-schema builds and analyses over cumulative daily counts, on Spark.

Every function takes and returns DataFrames and starts no job of its own; reading and
writing happen in ``sources`` and ``sinks``, and ``plans.build`` puts a whole run together.
"""
