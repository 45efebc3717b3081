from .ingest import failures, ingest_all, ingest_table

__all__ = ["failures", "ingest_all", "ingest_table"]
