"""Errors raised by the argument and table checks."""


class TableCheckError(ValueError):
    """A table or a record breaks the declared schema or value rules."""


class ParameterError(ValueError):
    """One or more hyper-parameters break the rule table."""


class UnknownVersionError(LookupError):
    """A model version is not (or no longer) in the registry."""
