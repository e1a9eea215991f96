from partflow.sinks import export, tables

__all__ = ["export", "tables"]
