"""Exact deduplication by a 128-bit content hash, with a byte comparison.

Texts are equal if they are identical after lower-casing A-Z only; null counts as
empty. Only hashes and ids are shuffled; the texts of rows whose hash repeats are
pre-aggregated in each task, so a group of copies crosses the network once per
task and not once per row. A group with many rows is split when its decision is
joined back.

Of equal texts the row with the largest id stays (a null id is the smallest). If
that id repeats within the group, one of its rows stays. An empty table gives an
empty result; other columns, whatever their names, are not read, or come out as they
came in.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joining import JoinLimits, attach_totals, store_totals
from ..workspace import Workspace

# Names of this module's own columns. A row of the input with all its columns is one
# struct, ``_ALL``, wherever it is carried along, so no name of the input meets these.
_HASH, _BODY, _ROW, _KEEP, _TOP, _ALL = "_hash", "_body", "_row", "_keep", "_top", "_all"


def normalised(text: Column | str) -> Column:
    """The compared form of a text: A-Z in lower case, null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


def content_hash(body: Column) -> Column:
    """128 bits of content."""
    return F.unhex(F.md5(body))


def _repeated(hashed: DataFrame, workspace: Workspace, limits: JoinLimits):
    groups = hashed.groupBy(_HASH).agg(F.count("*").alias("rows")).filter("rows > 1")
    stored, sizes = store_totals(groups, workspace, "repeated-hashes", limits=limits)
    return stored, sizes[None]


def _collided(
    bodies: DataFrame, repeated: DataFrame, size, workspace: Workspace, limits: JoinLimits
) -> DataFrame:
    """Hashes that different texts share, found by comparing whole texts."""
    members = attach_totals(bodies, repeated, [_HASH], ["_id"], size, limits)
    texts = members.groupBy(_HASH, _BODY).agg(F.count("*").alias("_n"))
    several = texts.groupBy(_HASH).agg(F.count("*").alias("_n")).filter("_n > 1")
    return workspace.store(several.select(_HASH), "collided-hashes")


def _decide(
    rows: DataFrame, keys: list[str], workspace: Workspace, limits: JoinLimits
) -> DataFrame:
    """Attach to each row its group's ``keep`` (id and row) and number of ``copies``."""
    groups = rows.groupBy(*keys).agg(
        F.max(F.struct("_id", _ROW)).alias(_KEEP), F.count("*").alias("rows")
    ).withColumn("copies", F.col("rows"))
    stored, sizes = store_totals(groups, workspace, "content-groups", limits=limits)
    return attach_totals(rows, stored, keys, ["_id", _ROW], sizes[None], limits).select(
        F.col("_id"), F.col(f"{_KEEP}._id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col(_ROW) == F.col(f"{_KEEP}.{_ROW}")).alias("kept"), "_sha256",
    )


def exact_groups(
    docs: DataFrame,
    workspace: Workspace,
    id_column: str = "doc_id",
    text_column: str = "text",
    hash_of: Callable[[Column], Column] = content_hash,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """One row per document: id, ``keep_id, group_size, kept, text_sha256``.

    ``hash_of`` is exchangeable so that tests can force collisions.
    """
    body = normalised(F.col(text_column))
    bodies = docs.select(F.col(id_column).alias("_id"), body.alias(_BODY)).withColumn(
        _HASH, hash_of(F.col(_BODY))
    )
    hashed = workspace.store(bodies.select(
        "_id", F.monotonically_increasing_id().alias(_ROW), _HASH,
        F.unhex(F.sha2(_BODY, 256)).alias("_sha256"),
    ), "content-hashes")
    collided = _collided(bodies, *_repeated(hashed, workspace, limits), workspace, limits)
    if collided.isEmpty():
        found = _decide(hashed, [_HASH], workspace, limits)
    else:
        apart = workspace.store(
            bodies.join(collided, _HASH, "left_semi").select(
                "_id", F.monotonically_increasing_id().alias(_ROW), _HASH, _BODY,
                F.unhex(F.sha2(_BODY, 256)).alias("_sha256"),
            ), "collided-texts",
        )
        found = _decide(hashed.join(collided, _HASH, "left_anti"), [_HASH], workspace, limits).union(
            _decide(apart, [_HASH, _BODY], workspace, limits)
        )
    return found.select(
        F.col("_id").alias(id_column), "keep_id", "group_size", "kept",
        F.lower(F.hex("_sha256")).alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame,
    workspace: Workspace,
    id_column: str = "doc_id",
    text_column: str = "text",
    hash_of: Callable[[Column], Column] = content_hash,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """The rows that stay, with all their columns, whatever these are named.

    Rows are told apart by id and text, so the texts themselves stay where they
    are unless the table of groups is too large to broadcast.
    """
    body = normalised(F.col(text_column)).alias(_BODY)
    marked = docs.select(F.struct("*").alias(_ALL), F.col(id_column).alias("_id"), body).withColumn(
        _HASH, hash_of(F.col(_BODY))
    )
    bodies = marked.drop(_ALL)
    hashed = workspace.store(bodies.select("_id", _HASH), "content-hashes")
    repeated, size = _repeated(hashed, workspace, limits)
    collided = _collided(bodies, repeated, size, workspace, limits)
    keys = [_HASH] if collided.isEmpty() else [_HASH, _BODY]
    source = hashed if collided.isEmpty() else bodies
    # How often the kept id occurs tells whether equal ids must be told apart too.
    groups = source.groupBy(*keys, "_id").agg(F.count("*").alias(_TOP)).groupBy(*keys).agg(
        F.max(F.struct("_id", _TOP)).alias(_KEEP), F.sum(_TOP).alias("rows")
    ).filter("rows > 1")
    stored, sizes = store_totals(groups, workspace, "content-groups", limits=limits)
    again = stored.filter(F.col(f"{_KEEP}.{_TOP}") > 1).select(*keys)

    top, own = F.col(f"{_KEEP}.{_TOP}"), F.col("_id").eqNullSafe(F.col(f"{_KEEP}._id"))
    if sizes[None].bytes <= limits.broadcast_bytes:
        grouped = marked.join(F.broadcast(stored.drop("rows")), keys, "left")
        kept = grouped.filter(F.col(_KEEP).isNull() | (own & (top == 1))).select(_ALL)
    else:  # both sides are shuffled, rows of a large group to several tasks
        grouped = attach_totals(marked, stored, keys, ["_id"], sizes[None], limits)
        alone = marked.join(stored.select(*keys), keys, "left_anti")
        kept = alone.select(_ALL).union(grouped.filter(own & (top == 1)).select(_ALL))
    if not again.isEmpty():
        kept = kept.union(grouped.filter(own & (top > 1)).dropDuplicates(keys).select(_ALL))
    return kept.select(f"{_ALL}.*")
