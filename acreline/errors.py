"""The one error raised for data (not argument) problems."""

from __future__ import annotations


class DataValidationError(ValueError):
    """The data breaks a contract, a gate or a guard.

    ``failures`` holds a small, readable account: one string per problem found.
    """

    def __init__(self, message: str, failures: list[str] | None = None) -> None:
        super().__init__(message)
        self.failures = failures or []
