from casebook.sources.tables import TABLES, load

__all__ = ["TABLES", "load"]
