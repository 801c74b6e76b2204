"""Registered queries over the benchmark tables, each with a SQL statement that checks it.

``feeds``    the eight raw feeds derived from the benchmark tables
``oracle``   SQL for the feeds and the tables built from them
``layers``   queries for silver, gold, views, reports, validation and measures over those feeds
``direct``   queries that run the generic operators on the benchmark tables themselves
"""
