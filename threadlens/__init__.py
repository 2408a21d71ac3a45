"""threadlens: analytics over threaded discussion comments, expressed as Spark jobs.

Every public function takes and returns DataFrames; nothing is collected to the
driver inside a job.  Sub-packages:

* ``sources``   - schemas, JSON / Parquet readers, feed pages, name lists
* ``functions`` - column expressions (time slots, base-36 ids, stable hashes, titles)
* ``operators`` - the batch products (history, snapshot, graph, recommend, live, sink)
* ``streaming`` - Structured Streaming wrappers around the live operators
* ``plans``     - the registered queries, their DuckDB oracles and plan checks
"""

__version__ = "0.1.0"
