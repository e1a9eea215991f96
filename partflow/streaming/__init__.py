from partflow.streaming import ingest

__all__ = ["ingest"]
