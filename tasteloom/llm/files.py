"""Files that tasks write and read themselves."""

from tasteloom.sources.files import opened, written

__all__ = ["opened", "written"]
