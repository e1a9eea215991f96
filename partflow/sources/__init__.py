from partflow.sources import readers

__all__ = ["readers"]
