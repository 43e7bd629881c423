"""Fleet zone analytics as Spark DataFrame jobs.

``functions``  Column-level building blocks (geometry, triage rules, message text, latency)
``operators``  DataFrame -> DataFrame transformations (crossings, as-of joins, scoring, ...)
``sources``    readers, writers and the fixed reference tables
``plans``      ready-made queries over the standard tables, each with its SQL counterpart
``streaming``  the same detection and delivery as Structured Streaming queries
"""
