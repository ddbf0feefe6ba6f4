"""Change-record ingest, event-log jobs and link enrichment as Spark DataFrame functions."""
