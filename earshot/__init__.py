"""Listening-history and event-stream analytics on PySpark.

``earshot.plans`` holds the jobs and the analyses, ``earshot.operators`` the
reusable DataFrame operators, ``earshot.functions`` the column functions,
``earshot.sources`` the readers, tables and writers, and ``earshot.streaming``
the Structured Streaming jobs.
"""
