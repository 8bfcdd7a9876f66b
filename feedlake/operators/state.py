"""The checkpoint as a table ``request_key, kind, value``: watermarks and resume positions.

Watermarks are of kind ``digest`` or ``changed_since``; ``resume_offset`` and ``resume_digest`` mark
where a failed scan stopped. A null digest means the scope counts as changed every time. A null scope is a scope.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import null_safe

WATERMARKS = ("digest", "changed_since")
RESUMES = ("resume_offset", "resume_digest")
STATE_SCHEMA = "request_key string, kind string, value string"


def committed_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """State after a full success: new watermarks win, others are kept, no resume entries remain.

    A new null digest also wins, so presence decides, not ``coalesce``.
    """
    marks = [
        side.where(F.col("kind").isin(*WATERMARKS)).select("request_key", "kind", "value", F.lit(rank).alias("_rank"))
        for rank, side in enumerate((old, new))
    ]
    return marks[0].unionByName(marks[1]).groupBy("request_key", "kind").agg(F.max_by("value", "_rank").alias("value"))


def failed_state(old: DataFrame, resume: DataFrame, finished: DataFrame) -> DataFrame:
    """State after a failure: watermarks as before, resume entries gathered so far kept.

    A scope that finished, or that has a new position, loses its earlier entry.
    """
    marks = old.where(F.col("kind").isin(*WATERMARKS)).select("request_key", "kind", "value")
    settled = finished.select("request_key").union(resume.select("request_key")).distinct()
    carried = null_safe(old.where(F.col("kind").isin(*RESUMES)), settled, ["request_key"], "left_anti")
    return marks.unionByName(carried.select("request_key", "kind", "value")).unionByName(
        resume.where(F.col("kind").isin(*RESUMES)).select("request_key", "kind", "value")
    )


def digest_watermarks(facts: DataFrame) -> DataFrame:
    """Digest rows of the finished scopes: the digest of their first page, null where it gave none.

    ``facts`` is the scope-facts table of a page log. A scope answered "not modified" at once has no
    page and leaves its watermark alone.
    """
    read = facts.where(F.col("end_offset").isNotNull() & F.col("opened"))
    return read.select("request_key", F.lit("digest").alias("kind"), F.col("first_digest").alias("value"))


def finished_scopes(facts: DataFrame) -> DataFrame:
    """Keys of the scopes whose latest attempt reached its end."""
    return facts.where("end_offset is not null").select("request_key")


def resume_entries(facts: DataFrame) -> DataFrame:
    """Resume rows of the unfinished scopes: next offset and the digest it is valid for.

    Scopes without a digest get none, since their position could never be verified.
    """
    known = "end_offset is null and next_offset is not null and first_digest is not null"
    entries = F.array(
        F.struct(F.lit("resume_offset").alias("kind"), F.col("next_offset").cast("string").alias("value")),
        F.struct(F.lit("resume_digest").alias("kind"), F.col("first_digest").alias("value")),
    )
    return facts.where(known).select("request_key", F.inline(entries))


def resume_starts(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Where each scope of ``current`` (``request_key, digest``) starts, as ``start_offset``.

    A saved position counts only if its digest is known and still the current one; else 0.
    """
    wide = saved.where(F.col("kind").isin(*RESUMES)).groupBy("request_key").agg(
        F.max(F.when(F.col("kind") == "resume_offset", F.col("value"))).cast("long").alias("_offset"),
        F.max(F.when(F.col("kind") == "resume_digest", F.col("value"))).alias("_digest"),
    )
    verified = (F.col("_offset") > 0) & (F.col("_digest") == F.col("digest"))
    return null_safe(current, wide, ["request_key"], "left").select(
        "request_key", F.coalesce(F.when(verified, F.col("_offset")), F.lit(0)).alias("start_offset")
    )
