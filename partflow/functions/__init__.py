from partflow.functions import codes, dates, hashing, labels, names, numbers

__all__ = ["codes", "dates", "hashing", "labels", "names", "numbers"]
