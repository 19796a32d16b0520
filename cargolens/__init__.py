"""Customs import analytics as lazy PySpark DataFrame functions.

Sub-packages: ``functions`` (column expressions), ``operators`` (frame to frame
steps), ``plans`` (the composed reports), ``sources`` (scans and sinks) and
``streaming`` (incremental upsert and running totals).
"""
