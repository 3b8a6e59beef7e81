"""Upsert (MERGE) without a transactional table format (K1, K2, E4, E5), and its change feed (K6).

``upsert(target, source, keys)`` returns the new snapshot of ``target``:

* target rows whose key matches a source row take the source's values
  (all columns, or only ``set_cols``); the other target rows are kept as is;
* source rows whose key matches no target row are inserted (all columns, or
  only ``insert_cols``; target columns not given are NULL).

MERGE rules kept: a NULL in the key never matches (so such a source row is
inserted); several target rows matching one source row are all updated;
several source rows matching one target row is an error (``strict=False``
gives every match a row instead).  A caller whose source is unique by construction
(deduplicated or grouped on the key) says so with ``unique=True``, which saves the check.

With ``sequence`` a matched row is updated only if the source's value in that column is not lower than
the target's (a NULL there is lowest): batches may then arrive in any order, or
again, and a late one never overwrites a newer value.

``upsert_changes`` gives the rows that the same merge inserts and updates, as a change feed.

Plan shapes.  When the source (a batch) is within the broadcast bound and much smaller than the target,
neither join moves the target: the update is a broadcast left join and the
"already present" keys come from a broadcast semi join over the target's
key columns only, after which inserts are an anti join of two small sides.
The target — the large table — is scanned twice (once only its key
columns) and never shuffled.  Otherwise, and always for the change feed, one full outer join moves
each side once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.materialize import materialize as materialize_df
from kiln.operators.diff import CHANGE_TYPE
from kiln.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimated_bytes, fits

_M, _T, _SEQ = "__kiln_matched", "__kiln_target", "__kiln_sequence"
#: a target of fewer times the source's size is moved rather than scanned twice
MUCH_SMALLER = 8


class AmbiguousMergeError(ValueError):
    """Several source rows match the same target row."""


def _expr(v: Column | str) -> Column:
    return F.col(v) if isinstance(v, str) else v


def check_unambiguous(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs several times in the source and at all in the target.

    The target is only looked at if the source repeats a key.
    """
    dup = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    if dup.isEmpty():
        return
    if not dup.join(target.select(*keys), list(keys), "left_semi").isEmpty():
        raise AmbiguousMergeError(f"several source rows match one target row on {list(keys)}")


def _checked(target: DataFrame, source: DataFrame, keys: Sequence[str], strict: bool, unique: bool,
             materialize: bool) -> DataFrame:
    if materialize:
        source = materialize_df(source, "upsert-source")
    if strict and not unique:
        check_unambiguous(target, source, keys)
    return source


def _newer(sequence: str | None) -> Column:
    """The matched source row may update: it is not older than the target row."""
    if sequence is None:
        return F.col(_M)
    return F.col(_M) & (F.col(sequence).isNull() | F.coalesce(F.col(_SEQ) >= F.col(sequence), F.lit(False)))


def _columns(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols, insert_cols) -> tuple[Mapping, Mapping]:
    if set_cols is None:
        set_cols = {c: c for c in target.columns if c not in keys and c in source.columns}
    if insert_cols is None:
        insert_cols = {c: c for c in target.columns if c in source.columns}
    return set_cols, insert_cols


def _source_side(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols, sequence: str | None,
                 insert_cols=None) -> DataFrame:
    """Keys in the target's types, new values as ``__s_``, values to insert as ``__i_``."""
    types = {f.name: f.dataType for f in target.schema.fields}
    out = [F.col(k).cast(types[k]).alias(k) for k in keys]
    out += [_expr(v).cast(types[t]).alias(f"__s_{t}") for t, v in set_cols.items()]
    if insert_cols is not None:
        out += [(_expr(insert_cols[c]) if c in insert_cols else F.lit(None)).cast(types[c]).alias(f"__i_{c}")
                for c in target.columns]
    if sequence is not None:
        out.append(F.col(sequence).cast(types[sequence]).alias(_SEQ))
    return source.select(*out, F.lit(True).alias(_M))


def _joined(target: DataFrame, source: DataFrame, keys: Sequence[str], set_cols, insert_cols,
            sequence: str | None) -> DataFrame:
    side = _source_side(target, source, keys, set_cols, sequence, insert_cols)
    return target.withColumn(_T, F.lit(True)).join(side, list(keys), "full_outer")


def _after(c: str, set_cols, sequence: str | None) -> Column:
    return F.when(_newer(sequence), F.col(f"__s_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           set_cols: Mapping[str, Column | str] | None = None,
           insert_cols: Mapping[str, Column | str] | None = None,
           strict: bool = True,
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
           materialize: bool = True, unique: bool = False, sequence: str | None = None) -> DataFrame:
    """New snapshot of ``target`` after merging ``source`` on ``keys``.

    Where the source feeds the ambiguity check or several join branches, ``materialize`` computes it once and
    writes it as a table below the shared ``spark.checkpoint.dir`` (lineage cut, survives executor loss).
    Pass ``materialize=False`` when the source is already a stored table.
    """
    keys, tcols = list(keys), target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    set_cols, insert_cols = _columns(target, source, keys, set_cols, insert_cols)
    small = fits(source, max_broadcast_bytes) and estimated_bytes(target) >= MUCH_SMALLER * estimated_bytes(source)
    # a source known to be unique that is joined once need not be stored
    source = _checked(target, source, keys, strict, unique, materialize and (small or strict and not unique))

    if not small:
        joined = _joined(target, source, keys, set_cols, insert_cols, sequence)
        return joined.select(*[F.when(F.col(_T), _after(c, set_cols, sequence)).otherwise(F.col(f"__i_{c}")).alias(c)
                               for c in tcols])

    # --- matched and unmatched target rows -------------------------------
    upd = _source_side(target, source, keys, set_cols, sequence)
    kept_or_updated = target.join(F.broadcast(upd), keys, "left").select(
        *[_after(c, set_cols, sequence).alias(c) for c in tcols])

    # --- source rows with no target match --------------------------------
    tk = [f"__t_{k}" for k in keys]
    target_keys = target.select(*[F.col(k).alias(t) for k, t in zip(keys, tk)])
    on_key = [F.col(k).cast(types[k]) == F.col(t) for k, t in zip(keys, tk)]
    source_keys = F.broadcast(
        source.select(*[F.col(k).cast(types[k]).alias(t) for k, t in zip(keys, tk)]).distinct())
    # map-side semi join first (the target is not shuffled), then the
    # distinct of a result bounded by the source's key count
    present = target_keys.join(source_keys, tk, "left_semi").distinct()
    inserted = source.join(F.broadcast(present), on_key, "left_anti").select(*[
        (_expr(insert_cols[c]) if c in insert_cols else F.lit(None)).cast(types[c]).alias(c)
        for c in tcols])
    return kept_or_updated.unionByName(inserted)


def upsert_changes(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   set_cols: Mapping[str, Column | str] | None = None,
                   insert_cols: Mapping[str, Column | str] | None = None,
                   strict: bool = True, materialize: bool = True, unique: bool = False,
                   sequence: str | None = None, change_col: str = CHANGE_TYPE) -> DataFrame:
    """What ``upsert`` with the same arguments changes: inserted rows, and updated rows before and after.

    The feed comes from the merge's own join, so it reads the target once (a target
    restricted to the batch's partitions: only those) and compares no snapshots.  A match that
    leaves all values as they were is no change.  Equal to ``snapshot_diff`` of before and after.
    """
    keys, tcols = list(keys), target.columns
    set_cols, insert_cols = _columns(target, source, keys, set_cols, insert_cols)
    source = _checked(target, source, keys, strict, unique, materialize and strict and not unique)
    joined = _joined(target, source, keys, set_cols, insert_cols, sequence)

    def image(kind: str, value) -> Column:
        return F.struct(*[value(c).alias(c) for c in tcols], F.lit(kind).alias(change_col))

    differs = F.lit(False)
    for c in set_cols:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    before, after = image("update_preimage", F.col), image("update_postimage", lambda c: _after(c, set_cols, sequence))
    changes = (F.when(F.col(_T).isNull(), F.array(image("insert", lambda c: F.col(f"__i_{c}"))))
               .when(_newer(sequence) & differs, F.array(before, after)))
    return joined.select(F.explode(changes).alias("__change")).select("__change.*")
