"""Analytics over catalogs of software repositories, expressed as Spark jobs.

``functions``  Column -> Column expressions (urls, markdown, classification, scores)
``operators``  DataFrame -> DataFrame building blocks (dedupe, diff, findings, ranks)
``sources``    readers and writers
``plans``      end-to-end compositions
``streaming``  incremental ingest
"""
