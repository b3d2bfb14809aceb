from tomegauge.sources import books, dictionaries, tables

__all__ = ["books", "dictionaries", "tables"]
