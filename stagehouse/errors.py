"""Errors raised by the table verbs.  Each carries a message and, when there is one, the cause."""

from __future__ import annotations


class StagedTransferError(Exception):
    """Base of every error of this package; ``cause`` is the error behind it, or None."""

    def __init__(self, message: str, cause: BaseException | None = None):
        super().__init__(message)
        self.message = message
        self.cause = cause
        if cause is not None:
            self.__cause__ = cause


class OptionError(StagedTransferError, ValueError):
    """Options missing, in conflict or unknown.  Raised before any job starts."""


class SchemaError(StagedTransferError, ValueError):
    """A column is missing, has a type that cannot be carried, or breaks the table's layout."""


class LoadError(StagedTransferError):
    """Loading a table failed; the table keeps the content it had."""
