"""What the page source asks for and gets back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class ScopeRequest:
    """One scope to read page by page.

    ``stored_digest`` is sent as a condition; it is left out when resuming, where
    ``resume_offset`` counts only if the first answer still carries ``resume_digest``. A scope whose
    page boundaries are known can be split: such a part sets ``start_offset`` and ``stop_offset``.
    """

    request_key: str
    path: str
    params: dict[str, Any]
    count: int
    conditional: bool = True
    stored_digest: str | None = None
    resume_offset: int = 0
    resume_digest: str | None = None
    attempt: int = 1
    start_offset: int = 0
    stop_offset: int | None = None


@dataclass(frozen=True)
class PageRequest:
    """One page request as handed to the caller's fetch function."""

    path: str
    params: dict[str, Any]
    headers: dict[str, str]


@dataclass(frozen=True)
class PageResponse:
    """The answer: an HTTP-like status and the decoded body ``{"values": [...], "versionDigest": ...}``."""

    status: int = 200
    body: dict[str, Any] = field(default_factory=dict)


Fetch = Callable[[PageRequest], PageResponse]
