"""Failures that a batch can have; a batch fails as a whole, rows are never silently dropped."""


class TickloomError(Exception):
    """Base of all."""


class Contract(TickloomError):
    """A value breaks the data model."""


class MixedProvenance(TickloomError):
    """Rows of more than one source in one dataset."""


class IncompleteWindow(TickloomError):
    """Evidence for a complete window is missing."""


class UnexpectedSymbol(TickloomError):
    """A symbol outside the expected ones."""


class UnsupportedEvent(TickloomError):
    """An event kind that the operator does not take."""


class InputLimit(TickloomError):
    """More rows or bytes than allowed; limits fail, they never truncate."""


class DecimalOverflow(TickloomError):
    """A number that exact decimals cannot hold."""


class CacheConflict(TickloomError):
    """Versions that cannot be reconciled."""
