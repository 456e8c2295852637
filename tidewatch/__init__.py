"""Tidewatch: situation analytics over news-event feeds, as Spark DataFrame operators.

``functions``  Column expressions: text, URLs, numbers and times, geography, scores
``sources``    table schemas, feed readers, versioned Parquet snapshots
``operators``  DataFrame to DataFrame: normalising, grouping, ranking, linking, alerting
``plans``      composed queries: serving, ingesting, and the query catalogue
``streaming``  the incremental form of ingestion
"""
