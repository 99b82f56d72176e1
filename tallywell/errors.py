"""Errors that tell a problem of the data apart from a programming mistake."""


class IngestError(Exception):
    """The input is missing, empty, unreadable or lacks required columns."""


class QualityError(Exception):
    """The data fall below the accepted quality and must not be published."""


class PersistError(Exception):
    """A result could not be written to or read from its destination."""


class LoadError(Exception):
    """A warehouse table could not be replaced."""
