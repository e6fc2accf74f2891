"""wardflow: healthcare-operations ingest, documents, upserts and reports as Spark jobs."""

__version__ = "0.1.0"
