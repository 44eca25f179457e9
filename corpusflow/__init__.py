"""corpusflow: document corpora -> retrieval-ready tables, as Spark jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL expressions, joins, aggregations and
windows. Python runs only in the few narrow stages that need it (text
splitter, exact HTML parser, embedding model), always over Arrow batches.

Sub-packages
------------
sources    scans: listings, file trees, pages, configs, index, state, fixtures
functions  column expressions: ids, text rules, titles, HTML, chunking, vectors
operators  DataFrame operators: extraction, filters, joins, aggregates, stores
plans      composed jobs (ingest) and the registered query set
streaming  Structured Streaming drivers (foreachBatch ingest, change detection)
"""

__version__ = "0.1.0"
