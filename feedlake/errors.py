"""Errors raised by the readers and operators."""

from __future__ import annotations

from typing import Any


class FeedError(Exception):
    """Base error: a message plus a details mapping."""

    def __init__(self, message: str, **details: Any) -> None:
        super().__init__(message)
        self.message = message
        self.details = details


class ReadError(FeedError):
    """Bad settings, bad data or a failed read."""


class ValidationError(FeedError):
    """Malformed entity metadata."""


class AuthenticationError(FeedError):
    """The source rejected the credentials."""


class AuthorizationError(FeedError):
    """The credentials do not allow this read."""


class SourceConnectionError(FeedError):
    """The source could not be reached."""


# Kinds that keep their own type when a read fails; every other kind surfaces as ReadError.
PASS_THROUGH: dict[str, type[FeedError]] = {
    "authentication": AuthenticationError,
    "authorization": AuthorizationError,
    "connection": SourceConnectionError,
}


def kind_of(exc: BaseException) -> str:
    """The kind under which a fetch failure is recorded in the page log."""
    for kind, cls in PASS_THROUGH.items():
        if isinstance(exc, cls):
            return kind
    return "connection" if isinstance(exc, ConnectionError) else "read"


def check_status(status: int) -> None:
    """Raise for an HTTP status that carries no page: all but 200 to 299 and 304 (not modified)."""
    if 200 <= status < 300 or status == 304:
        return
    kinds = {401: AuthenticationError, 403: AuthorizationError}
    raise kinds.get(status, SourceConnectionError if status >= 500 else ReadError)(f"the source answered with status {status}", status=status)
