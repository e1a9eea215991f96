from partflow.operators import aggregate, joins, project, quality, running, state

__all__ = ["aggregate", "joins", "project", "quality", "running", "state"]
