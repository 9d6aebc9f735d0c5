"""Training-data operators. Nothing outside this package imports it; queries live in ``avmatch.llm.queries``."""
