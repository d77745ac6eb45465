"""Subscription revenue on Spark: interval timelines, calendar proration and marts.

Layers, lowest first:

* ``functions`` - column expressions (text, dates, ranking, calendar blocks)
* ``operators`` - DataFrame in, DataFrame out; column names are parameters
* ``sources``   - declared schemas, delimited extracts, publishing
* ``plans``     - the subscription marts and their data-quality catalogue
"""
