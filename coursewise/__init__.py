"""coursewise: learning-platform warehouse jobs on PySpark.

Every operator is a plain function from DataFrame to DataFrame built on
Spark's own column functions, so Catalyst plans, prunes and pushes down the
whole job. Sub-packages:

* ``functions``  column-level helpers (cleaning, masking, JSON fields, calendar,
  casts, URL codec, emptiness tests)
* ``sources``    driver-table loaders, derived logs/feeds, JSON feed ingest
* ``operators``  behaviour analyses, member and quiz wide tables, exam reports
* ``plans``      sinks, table maintenance and the layered warehouse runner
* ``streaming``  incremental (file-stream) runs of the ingest and the cleaner
* ``catalog``    every registered query with its DuckDB oracle
* ``jobs``       command-line entry points (``python -m coursewise.jobs``)
"""
