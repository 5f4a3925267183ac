"""Errors raised by operators that must not return a partial result."""


class MusterlineError(Exception):
    """Base of all errors raised by this package."""


class ContractError(MusterlineError):
    """Rows break a contract and the caller asked for failure instead of quarantine."""


class PayloadError(MusterlineError):
    """A landed JSON payload is not an array of objects."""


class DuplicateKeyError(MusterlineError):
    """A batch repeats a key, or brings one the table already holds."""


class MissingKeyError(MusterlineError):
    """A change addresses a key the table does not hold."""


class SourceError(MusterlineError):
    """None of the offered sources holds any row."""


class PublishConflictError(MusterlineError):
    """Another publisher took the same version of a table first."""


class StreamOwnerError(MusterlineError):
    """A stream would write into a folder that belongs to another stream or checkpoint."""
