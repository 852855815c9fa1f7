"""Exceptions raised by the library."""


class ResultLakeError(Exception):
    """Base of every error the library raises on purpose."""


class CollectionError(ResultLakeError):
    """Extraction of result pages could not be run."""


class ExportError(ResultLakeError):
    """Result tables could not be written."""
