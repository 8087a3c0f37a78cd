"""Real-time commerce warehouse as Spark DataFrame transforms.

Layers: ``sources`` (topics, table views) -> ``operators`` (log and change
routing, dimensions, daily-active and order wide rows, serving queries) ->
``streaming`` (Structured Streaming forms and sinks) -> ``plans`` (the query
registry and its SQL twins).
"""
