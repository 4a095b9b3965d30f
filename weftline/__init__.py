"""weftline: evaluation records to supervised training text, as Spark plans."""
