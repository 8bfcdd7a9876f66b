"""Read settings and the checks that run before any request."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import types as T

from .catalog import CATALOG, EntitySpec, Pagination, entity_from_metadata
from .errors import ReadError, ValidationError
from .functions.selector import Selector, roots
from .operators.incremental import check_params
from .operators.paging import PAGE_SIZE


@dataclass(frozen=True, kw_only=True)
class ReadSettings:
    """One read: either a catalogue ``entity``, or a custom ``path`` with its own description.

    ``stable_sort_field`` applies to custom paths; an empty value opts out of sorting. ``schema``
    types the landed records (default: by the naming rules of the catalogue). ``as_of`` fixes "today"
    for windowed reads (default: the current UTC date).
    """

    entity: str | None = None
    path: str | None = None
    fields: Selector | None = None
    pagination: Pagination | str | None = None
    changed_since: bool | None = None
    explode_columns: list[str] | None = None
    stable_sort_field: str | None = "id"
    schema: T.StructType | None = None
    count: int = PAGE_SIZE
    params: dict[str, Any] | None = None
    date_from: str | None = None
    as_of: dt.date | None = None
    sep: str = "_"


def resolve(settings: ReadSettings, extra: dict[str, dict[str, Any]] | None = None) -> EntitySpec:
    """The entity to read, with every setting checked; raises :class:`ReadError`.

    ``extra`` adds entities by metadata mapping to the packaged catalogue.
    """
    spec = _catalogued(settings, extra or {}) if settings.entity else _custom(settings)
    spec = replace(spec, schema=settings.schema or spec.schema)
    windowed = spec.pagination is Pagination.DATE_WINDOW
    if settings.date_from is not None and not windowed:
        raise ReadError("date_from only applies to date-windowed reads", date_from=settings.date_from)
    if windowed and spec.changed_since:
        raise ReadError("changed_since cannot be combined with date windows", path=spec.path)
    check_params(settings.params)
    if spec.stable_sort_field and spec.stable_sort_field.split(".", 1)[0] not in roots(spec.fields):
        raise ReadError(
            f"stable_sort_field {spec.stable_sort_field!r} is not among the fields; add it, name another, or leave it empty",
            path=spec.path, stable_sort_field=spec.stable_sort_field,
        )
    return spec


def _catalogued(settings: ReadSettings, extra: dict[str, dict[str, Any]]) -> EntitySpec:
    given = [name for name in ("path", "fields", "pagination", "explode_columns") if getattr(settings, name)]
    if settings.changed_since is not None:
        given.append("changed_since")
    if given:
        raise ReadError(f"{given} describe a custom path and do not go with an entity", entity=settings.entity)
    if settings.entity in extra:
        try:
            return entity_from_metadata(settings.entity, extra[settings.entity])
        except ValidationError as exc:
            raise ReadError(exc.message, **exc.details) from exc
    if settings.entity not in CATALOG:
        raise ReadError(f"unknown entity: {settings.entity!r}", entity=settings.entity)
    return CATALOG[settings.entity]


def _custom(settings: ReadSettings) -> EntitySpec:
    if not settings.path:
        raise ReadError("either an entity or a path must be given")
    missing = [name for name in ("fields", "pagination") if not getattr(settings, name)]
    if settings.changed_since is None:
        missing.append("changed_since")
    if missing:
        raise ReadError(f"a custom path also needs {missing}", path=settings.path)
    try:
        pagination = Pagination(settings.pagination)
    except ValueError as exc:
        raise ReadError(str(exc), path=settings.path) from exc
    return EntitySpec(
        path=settings.path,
        fields=settings.fields,
        changed_since=settings.changed_since,
        pagination=pagination,
        explode_columns=tuple(settings.explode_columns or ()),
        stable_sort_field=settings.stable_sort_field,
    )


def reader_kind(spec: EntitySpec) -> str:
    """Which scan serves the entity: ``windowed``, ``changed_since`` or ``digest``."""
    if spec.pagination is Pagination.DATE_WINDOW:
        return "windowed"
    return "changed_since" if spec.changed_since else "digest"
