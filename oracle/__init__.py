"""Reference answers for every registered query, as SQL for an embedded database."""

from oracle.statements import statements

__all__ = ["statements"]
