"""Table maintenance as pure snapshot transforms.

Parquet tables have no row-level UPDATE/DELETE/MERGE in Spark without an
extra table format, and a table cannot be overwritten while it is read.  So
every operation here takes the current snapshot and returns a
``DmlResult``: the new snapshot, the ``RETURNING`` rows, audit rows (what
the reference's triggers would have logged) and the delta (old rows with
``_sign`` -1, new rows with +1).  All are lazy DataFrames; nothing is executed
until a caller writes or reads them.  ``publish.py`` writes a snapshot as a
new version, rebased by its delta where another writer came first, and
``refresh.py`` brings stored aggregates up to date from deltas.

Audit rows are emitted from the *matched* rows, not from a diff of old and
new values, so an UPDATE that leaves a value unchanged is still logged, as a
row trigger would.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import broadcast_if_bounded
from .subqueries import any_row
from .windows import distinct_on

SRC = "_src_"


@dataclass
class DmlResult:
    snapshot: DataFrame
    returning: DataFrame | None = None
    audit: DataFrame | None = None
    delta: DataFrame | None = None


SIGN = "_sign"


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign))


def _old_and_new(changed: DataFrame, old: Sequence[Column], new: Sequence[Column]) -> DataFrame:
    """Two rows for each changed one: the old with -1 and the new with +1, in one pass."""
    pair = F.array(F.struct(*old, F.lit(-1).alias(SIGN)), F.struct(*new, F.lit(1).alias(SIGN)))
    return changed.select(F.inline(pair))


def S(name: str) -> Column:
    """Reference a *source* column inside a MERGE condition or assignment."""
    return F.col(SRC + name)


def _stamp(at: Column | str | None, user: str | None) -> list[Column]:
    ts = F.current_timestamp() if at is None else (
        F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at)
    who = F.current_user() if user is None else F.lit(user)
    return [ts.alias("changed_at"), who.alias("user_name")]


def _align(rows: DataFrame, target: DataFrame, defaults: Mapping | None = None) -> DataFrame:
    """Project ``rows`` onto the target schema by name (INSERT column list).

    Names match regardless of case; a column the target lacks is an error.
    """
    given = {c.lower(): c for c in rows.columns}
    unknown = sorted(set(given) - {f.name.lower() for f in target.schema.fields})
    if unknown or len(given) < len(rows.columns):
        raise ValueError(f"columns not in the target or given twice: {unknown or rows.columns}")
    cols = []
    for f in target.schema.fields:
        if f.name.lower() in given:
            cols.append(F.col(given[f.name.lower()]).cast(f.dataType).alias(f.name))
        elif defaults and f.name in defaults:
            d = defaults[f.name]
            cols.append((d if isinstance(d, Column) else F.lit(d)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rows.select(*cols)


def insert(target: DataFrame, rows: DataFrame, defaults: Mapping | None = None,
           audit_keys: Sequence[str] = (), at=None, user=None) -> DmlResult:
    """``INSERT INTO target (cols) SELECT ...``; missing columns take defaults/NULL."""
    aligned = _align(rows, target, defaults)
    audit = aligned.select(F.lit("INSERT").alias("operation"), *audit_keys, *_stamp(at, user))
    return DmlResult(target.unionByName(aligned), aligned, audit, _signed(aligned, 1))


def update(target: DataFrame, assignments: Mapping[str, Column], where: Column | None = None,
           audit_keys: Sequence[str] = (), at=None, user=None) -> DmlResult:
    """``UPDATE target SET col = expr ... WHERE where``.

    A row whose predicate is NULL is not updated.  The audit has one row per
    updated row with old and new values of the assigned columns.
    """
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    flagged = target.withColumn("_u_hit", hit)
    new_cols = []
    for c in target.columns:
        if c in assignments:
            new_cols.append(F.when(F.col("_u_hit"), assignments[c]).otherwise(F.col(c))
                            .cast(target.schema[c].dataType).alias(c))
        else:
            new_cols.append(F.col(c))
    snapshot = flagged.select(*new_cols)
    changed = flagged.where(F.col("_u_hit"))
    new = [(assignments[c].cast(target.schema[c].dataType) if c in assignments else F.col(c)).alias(c) for c in target.columns]
    returning = changed.select(*new)
    audit = changed.select(
        F.lit("UPDATE").alias("operation"), *audit_keys,
        *[F.col(c).alias(f"old_{c}") for c in assignments],
        *[assignments[c].cast(target.schema[c].dataType).alias(f"new_{c}") for c in assignments],
        *_stamp(at, user))
    return DmlResult(snapshot, returning, audit, _old_and_new(changed, [F.col(c) for c in target.columns], new))


def delete(target: DataFrame, where: Column, audit_keys: Sequence[str] = (),
           at=None, user=None) -> DmlResult:
    """``DELETE FROM target WHERE where RETURNING *`` (NULL predicate keeps the row)."""
    hit = F.coalesce(where, F.lit(False))
    flagged = target.withColumn("_d_hit", hit)
    removed = flagged.where(F.col("_d_hit")).drop("_d_hit")
    audit = removed.select(F.lit("DELETE").alias("operation"), *audit_keys, *_stamp(at, user))
    return DmlResult(flagged.where(~F.col("_d_hit")).drop("_d_hit"), removed, audit, _signed(removed, -1))


def _duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # A key with a NULL conflicts with nothing.
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           check_duplicates: bool = True, audit_keys: Sequence[str] | None = None,
           at=None, user=None) -> DmlResult:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all> = EXCLUDED.<all>``.

    Planned as ``(target ANTI JOIN source) UNION ALL source``: one join on
    the key instead of a full outer join, and the source (usually far
    smaller) is the only side whose rows are rewritten.  PostgreSQL rejects a
    batch that touches the same key twice; so do we.
    """
    aligned = _align(source, target)
    if check_duplicates and any_row(_duplicate_keys(aligned, keys)):
        raise ValueError("upsert source has duplicate keys")
    src_keys = aligned.select(*keys)
    # A join USING moves the keys to the front; a snapshot keeps the target's order.
    kept = target.join(src_keys, list(keys), "left_anti").select(*target.columns)
    snapshot = kept.unionByName(aligned)
    existed = F.col("_up_hit").isNotNull()
    marked = aligned.join(target.select(*keys).withColumn("_up_hit", F.lit(True)), list(keys), "left")
    audit = marked.select(F.when(existed, "UPDATE").otherwise("INSERT").alias("operation"),
                          *(audit_keys or keys), *_stamp(at, user))
    replaced = target.join(src_keys, list(keys), "left_semi").select(*target.columns)
    return DmlResult(snapshot, aligned, audit, _signed(replaced, -1).unionByName(_signed(aligned, 1)))


@dataclass
class When:
    """One MERGE clause: ``WHEN [NOT] MATCHED AND cond THEN action``.

    ``action`` is ``"delete"``, or a mapping of column -> expression for
    UPDATE (matched) or INSERT (not matched).  Use ``S(col)`` for source
    columns; plain names are target columns.
    """
    matched: bool
    action: str | Mapping[str, Column]
    cond: Column | None = None


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[When],
          check_duplicates: bool = True, at=None, user=None) -> DmlResult:
    """``MERGE INTO target USING source ON keys WHEN ...`` (first true clause wins).

    Target rows meet their source rows in a left join, and source rows without
    a target row come from an anti join: both can be split on a hot key, which
    a full outer join cannot.  An ``action`` column records the clause that
    fired; snapshot, audit and delta are projections of that one frame.  A
    target row that two source rows would change is an error; duplicate source
    rows for which no clause fires are not.
    """
    src = source.select(*[F.col(c).alias(SRC + c) for c in source.columns]).withColumn("_m_src", F.lit(True))
    tgt = target.withColumn("_m_tgt", F.lit(True))
    in_t = F.col("_m_tgt").isNotNull()
    in_s = F.col("_m_src").isNotNull()
    action = F.lit(None).cast("int")
    for i, cl in reversed(list(enumerate(clauses))):
        base = (in_t & in_s) if cl.matched else (~in_t & in_s)
        fire = base if cl.cond is None else base & F.coalesce(cl.cond, F.lit(False))
        action = F.when(fire, F.lit(i)).otherwise(action)
    cond = None
    for k in keys:
        e = F.col(k) == F.col(SRC + k)
        cond = e if cond is None else cond & e

    dup = _duplicate_keys(source, keys).join(target.select(*keys), list(keys), "left_semi") if check_duplicates else None
    if dup is not None and any_row(dup):
        # Number the target's rows once, so that the pairs of one row can be told from those of another.
        path = scratch_path(target.sparkSession, "merge-target")
        tgt.withColumn("_m_row", F.monotonically_increasing_id()).write.parquet(path)
        tgt = target.sparkSession.read.parquet(path)
        pairs = tgt.join(src, cond, "left").withColumn("_m_act", action)
        twice = (pairs.where(F.col("_m_act").isNotNull()).groupBy("_m_row").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > 1))
        if any_row(twice):
            raise ValueError("MERGE: a target row is matched by more than one source row")
        nth = F.row_number().over(Window.partitionBy("_m_row").orderBy(F.col("_m_act").asc_nulls_last()))
        met = pairs.withColumn("_m_nth", nth).where(F.col("_m_nth") == 1).drop("_m_nth", "_m_row")
    else:
        met = tgt.join(src, cond, "left").withColumn("_m_act", action)
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    new = (src.join(target.select(*keys), cond, "left_anti").select(*blank, F.lit(None).cast("boolean").alias("_m_tgt"), *src.columns)
              .withColumn("_m_act", action))
    j = met.unionByName(new)

    out_cols = []
    for f in target.schema.fields:
        expr = F.col(f.name)  # unchanged target value
        for i, cl in enumerate(clauses):
            if isinstance(cl.action, str):
                continue
            if cl.matched and f.name in cl.action:
                expr = F.when(F.col("_m_act") == i, cl.action[f.name]).otherwise(expr)
            if not cl.matched:
                v = cl.action.get(f.name, F.lit(None))
                expr = F.when(F.col("_m_act") == i, v).otherwise(expr)
        out_cols.append(expr.cast(f.dataType).alias(f.name))
    deletes = [i for i, cl in enumerate(clauses) if cl.action == "delete"]
    inserts = [i for i, cl in enumerate(clauses) if not cl.matched and cl.action != "delete"]
    keep_target = in_t & (F.col("_m_act").isNull() | ~F.col("_m_act").isin(deletes or [-1]))
    keep_insert = ~in_t & F.col("_m_act").isin(inserts or [-1])
    snapshot = j.where(keep_target | keep_insert).select(*out_cols)
    names = ["delete" if cl.action == "delete" else ("update" if cl.matched else "insert") for cl in clauses]
    label = F.element_at(F.array(*[F.lit(n.upper()) for n in names]), F.col("_m_act") + 1) if names else F.lit(None)
    key_out = [F.coalesce(F.col(k), F.col(SRC + k)).alias(k) for k in keys]
    audit = j.where(F.col("_m_act").isNotNull()).select(label.alias("operation"), *key_out, *_stamp(at, user))
    old = [F.struct(*[F.col(f.name) for f in target.schema.fields], F.lit(-1).alias(SIGN))]
    now = [F.struct(*out_cols, F.lit(1).alias(SIGN))]
    updates = [i for i, cl in enumerate(clauses) if cl.matched and cl.action != "delete"]
    act = F.col("_m_act")
    pair = (F.when(act.isin(updates or [-1]), F.array(*old, *now)).when(in_t & act.isin(deletes or [-1]), F.array(*old))
             .when(~in_t & act.isin(inserts or [-1]), F.array(*now)))
    return DmlResult(snapshot, None, audit, j.where(act.isNotNull()).select(F.inline(pair)))


def cascade_update(child: DataFrame, fk: str, key_map: DataFrame, old: str = "old_key",
                   new: str = "new_key", max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``ON UPDATE CASCADE``: rewrite ``child.fk`` through an old->new key map.

    The map is broadcast only when its row count is checked to be small;
    otherwise the join shuffles on the key.  A key that the map gives two new
    values is an error, as the update of its parent would be.
    """
    if any_row(_duplicate_keys(key_map, [old])):
        raise ValueError("a key stands twice in the map of new keys")
    m = key_map.select(F.col(old).alias("_cu_old"), F.col(new).alias("_cu_new"))
    m = broadcast_if_bounded(m, max_broadcast_rows)
    j = child.join(m, child[fk] == m["_cu_old"], "left")
    return j.withColumn(fk, F.coalesce(F.col("_cu_new"), F.col(fk)).cast(child.schema[fk].dataType)) \
            .drop("_cu_old", "_cu_new").select(*child.columns)


def cascade_delete(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str) -> DmlResult:
    """``ON DELETE CASCADE`` one level: child rows referencing a deleted key."""
    dk = deleted_keys.select(F.col(key).alias("_cd_k"))
    kept = child.join(dk, child[fk] == dk["_cd_k"], "left_anti")
    removed = child.join(dk, child[fk] == dk["_cd_k"], "left_semi")
    return DmlResult(kept, removed, None, _signed(removed, -1))


def set_null(child: DataFrame, fk: str, deleted_keys: DataFrame, key: str) -> DataFrame:
    """``ON DELETE SET NULL``: referencing columns become NULL."""
    dk = deleted_keys.select(F.col(key).alias("_sn_k")).distinct().withColumn("_sn_hit", F.lit(True))
    j = child.join(dk, child[fk] == dk["_sn_k"], "left")
    return j.withColumn(fk, F.when(F.col("_sn_hit"), F.lit(None)).otherwise(F.col(fk))
                        .cast(child.schema[fk].dataType)).select(*child.columns)


def update_through_view(target: DataFrame, view_pred: Column, assignments: Mapping[str, Column],
                        where: Column | None = None, check_option: bool = True) -> DmlResult:
    """UPDATE through a filtered view ``WITH CHECK OPTION``.

    Only rows visible in the view are changed; with the check option the
    changed rows must still satisfy the view predicate, else the statement
    fails (nothing is applied).
    """
    pred = view_pred if where is None else (view_pred & where)
    res = update(target, assignments, pred)
    if check_option:
        bad = res.returning.where(~F.coalesce(view_pred, F.lit(False)))
        if any_row(bad):
            raise ValueError("new row violates check option for view")
    return res


def insert_new_only(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                    order: Sequence) -> tuple[DataFrame, DataFrame]:
    """Reject incoming rows whose key exists (the BEFORE INSERT trigger).

    The first row of a key in ``order`` is the candidate and all later ones,
    equal rows included, are rejected as duplicates, so accepted and rejected
    rows together are the batch.  The batch is written once with a number per
    row; the first row of a key comes from a partial limit of one before the
    shuffle, and the rest from an anti join on the number, so a hot key is
    never gathered.  A key with a NULL is never a duplicate.  Candidates whose
    key exists in the target are rejected.  Returns ``(accepted, rejected)``;
    ``rejected`` has a ``reason`` column.
    """
    spark, names = batch.sparkSession, batch.columns
    path = scratch_path(spark, "insert-batch")
    numbered = batch.withColumn("_ino_row", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    keyed = numbered.dropna(subset=list(keys))
    first = distinct_on(keyed, keys, [*order, "_ino_row"])
    dups = keyed.join(first.select("_ino_row"), "_ino_row", "left_anti").select(*names, F.lit("duplicate in batch").alias("reason"))
    tkeys = target.select(*keys)  # semi/anti joins only test existence
    no_key = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    unkeyed = numbered.where(no_key)
    accepted = first.join(tkeys, list(keys), "left_anti").select(*names).unionByName(unkeyed.select(*names))
    existing = first.join(tkeys, list(keys), "left_semi").select(*names, F.lit("key exists").alias("reason"))
    return accepted, existing.unionByName(dups)
