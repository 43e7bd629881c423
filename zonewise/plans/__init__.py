"""Ready-made queries over the standard tables.

Each query is a Spark plan made from the library's operators together with an independent
SQL statement for the same result, so the two can be compared on any data.
"""
