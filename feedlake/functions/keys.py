"""Scope keys: one hash per request shape, shared by every page of that request.

The hashed text holds name and value of everything that shapes the request, each with its length before it, so no two
shapes share a text. Bounds of a window come last, which lets a column of windows share the rest.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from hashlib import sha256
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .selector import Selector, render


def canonical(named: Iterable[tuple[str, str | None]]) -> str:
    """The pairs as one text, in their order; a missing value is a dash."""
    return "".join(f"{len(name)}:{name}" + ("-" if value is None else f"{len(value)}:{value}") for name, value in named)


def request_text(path: str, fields: Selector, sort_field: str | None, params: dict[str, Any] | None) -> str:
    """What a request asks for, without its window; filters in the order of their names."""
    filters = [(f"?{name}", json.dumps(value, sort_keys=True, default=str)) for name, value in sorted((params or {}).items())]
    return canonical([("path", path), ("select", render(fields)), ("order", sort_field or None), *filters])


def scope_key(
    path: str,
    fields: Selector,
    sort_field: str | None,
    params: dict[str, Any] | None = None,
    window: tuple[str, str] | None = None,
) -> str:
    """Key of one request: page position and size are not part of it."""
    bounds = canonical(zip(("since", "until"), window, strict=True)) if window else ""
    return sha256((request_text(path, fields, sort_field, params) + bounds).encode()).hexdigest()


def window_scope_key(
    path: str,
    fields: Selector,
    sort_field: str | None,
    params: dict[str, Any] | None,
    period_from: Column,
    period_to: Column,
) -> Column:
    """:func:`scope_key` for a table of windows with date bounds."""
    parts = [F.lit(request_text(path, fields, sort_field, params))]
    for name, bound in (("since", period_from), ("until", period_to)):
        text = bound.cast("string")
        parts += [F.lit(f"{len(name)}:{name}"), F.length(text).cast("string"), F.lit(":"), text]
    return F.sha2(F.concat(*parts), 256)
