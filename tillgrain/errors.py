"""Errors raised by the gates and the sources."""


class DataContractError(ValueError):
    """The input does not meet the transaction contract."""


class ModelError(RuntimeError):
    """A model cannot be fitted or read."""
