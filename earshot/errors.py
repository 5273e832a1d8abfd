"""Errors a caller may want to catch."""

from __future__ import annotations

from collections.abc import Iterable


class _NamedError(Exception):
    """An error whose text starts with the name of its class."""

    def __init__(self, error: str):
        super().__init__(error)
        self.error = error

    def __str__(self) -> str:
        return f"{type(self).__name__}: {self.error}"


# fixed values: the names of the next two classes
class UnsupportedFileFormatException(_NamedError):
    """The path has an extension that no reader handles."""


class MissingDataException(_NamedError):
    """The input lacks fields that the star schema needs."""


class OrphanRowsError(_NamedError):
    """Rows of a fact table point at parents that do not exist."""

    def __init__(self, table: str, broken: Iterable[str]):
        self.broken = tuple(broken)
        super().__init__(f"{table} has rows without a parent: {', '.join(self.broken)}")
