"""Foreign keys with actions, and deletes and key updates that follow them.

A ``Schema`` holds tables (snapshots) and declared foreign keys.  ``delete``
removes rows of one table and everything that its ``CASCADE`` keys reach, over
any number of tables, through cycles and self references; ``update_keys``
gives rows new key values and lets referencing columns follow.  Both return a
``DmlResult`` per changed table, so the results can be published, audited or
used to refresh aggregates.

The walk of a delete goes in rounds: a round takes the rows that the last one
removed and finds the rows that reference them, one semi join per foreign key;
a row is taken once.  Rounds are as many as the longest path of references
between rows that pass the delete on (one more ends the walk), and each is
written to the shared scratch folder.  Tables that pass nothing on take part
once, at the end, and each table is rewritten once.

As in SQL, a referencing column set with a NULL references nothing (MATCH
SIMPLE).  ``RESTRICT`` refuses a delete of rows that any row references, also
one that would go with them; ``NO_ACTION`` refuses it only if such a row is
left.  Primary keys must identify rows, or a removed row takes those that
share its key with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .dml import SIGN, DmlResult
from .subqueries import any_row

CASCADE, SET_NULL, RESTRICT, NO_ACTION = "CASCADE", "SET NULL", "RESTRICT", "NO ACTION"


class Restricted(RuntimeError):
    """A row that a foreign key protects would lose what it references."""


@dataclass(frozen=True)
class ForeignKey:
    child: str
    columns: tuple[str, ...]
    parent: str
    references: tuple[str, ...]
    on_delete: str = NO_ACTION
    on_update: str = NO_ACTION

    def __post_init__(self) -> None:
        if len(self.columns) != len(self.references) or not self.columns:
            raise ValueError("a foreign key has as many columns as it references")
        if not {self.on_delete, self.on_update} <= {CASCADE, SET_NULL, RESTRICT, NO_ACTION}:
            raise ValueError("unknown action of a foreign key")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _null_safe(columns: Sequence[str], left: str, right: str) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


@dataclass
class Schema:
    """Tables with their primary keys and the foreign keys between them."""

    tables: Mapping[str, DataFrame]
    primary_keys: Mapping[str, tuple[str, ...]]
    foreign_keys: Sequence[ForeignKey] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        for fk in self.foreign_keys:
            if fk.child not in self.tables or fk.parent not in self.tables:
                raise ValueError(f"a foreign key names an unknown table: {fk}")

    def _pointing(self, fk: ForeignKey, gone: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows of the child that reference a row in ``gone`` (rows of the parent)."""
        child = self.tables[fk.child]
        keys = gone.select(*[F.col(r).alias(f"_fk{i}") for i, r in enumerate(fk.references)]).distinct()
        cond = F.lit(True)
        for i, c in enumerate(fk.columns):
            cond = cond & (F.col(c) == F.col(f"_fk{i}"))
        return child.join(keys, cond, how)

    # --------------------------------------------------------- delete

    def delete(self, table: str, where: Column) -> dict[str, DmlResult]:
        """``DELETE FROM table WHERE where`` with all that follows from it."""
        first = self.tables[table].where(F.coalesce(where, F.lit(False)))
        cascades = [fk for fk in self.foreign_keys if fk.on_delete == CASCADE]
        # Tables whose removed rows remove others are walked in rounds, all others once at the end.
        passing = {fk.parent for fk in cascades}
        fresh = {table: _written(first, "cascade")}
        gone: dict[str, DataFrame] = {}
        while fresh:
            for name, rows in fresh.items():
                gone[name] = rows if name not in gone else gone[name].unionByName(rows)
            found = self._reached([fk for fk in cascades if fk.child in passing], fresh)
            fresh = {}
            for name, rows in found.items():
                pk = self.primary_keys[name]
                if name in gone:
                    rows = rows.alias("n").join(gone[name].select(*pk).alias("g"), _null_safe(pk, "n", "g"), "left_anti")
                new = _written(rows.select(*self.tables[name].columns), "cascade")
                if not new.isEmpty():
                    fresh[name] = new
        for name, rows in self._reached([fk for fk in cascades if fk.child not in passing], gone).items():
            gone[name] = _written(rows.select(*self.tables[name].columns), "cascade")
        for fk in self.foreign_keys:
            if fk.on_delete == RESTRICT and fk.parent in gone and any_row(self._pointing(fk, gone[fk.parent])):
                raise Restricted(f"{fk.child} references rows of {fk.parent} that would go")
        return self._without(gone)

    def _reached(self, keys: Sequence[ForeignKey], gone: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Per child the rows that reference a row in ``gone``, each once."""
        found: dict[str, DataFrame] = {}
        for fk in keys:
            if fk.parent in gone:
                rows = self._pointing(fk, gone[fk.parent])
                found[fk.child] = rows if fk.child not in found else found[fk.child].unionByName(rows)
        # Two foreign keys can lead to one row.
        return {name: rows.dropDuplicates(list(self.primary_keys[name])) for name, rows in found.items()}

    def _without(self, gone: dict[str, DataFrame]) -> dict[str, DmlResult]:
        """Every table without its removed rows, references to removed rows emptied or refused."""
        out: dict[str, DmlResult] = {}
        for name, table in self.tables.items():
            rest = table
            if name in gone:
                pk = self.primary_keys[name]
                rest = table.alias("t").join(gone[name].select(*pk).alias("g"), _null_safe(pk, "t", "g"), "left_anti")
            emptied = rest
            touched = F.lit(False)
            for n, fk in enumerate(fk for fk in self.foreign_keys if fk.child == name and fk.parent in gone):
                if fk.on_delete == CASCADE:
                    continue
                keys = gone[fk.parent].select(*[F.col(r).alias(f"_fk{n}_{i}") for i, r in enumerate(fk.references)]).distinct()
                cond = F.lit(True)
                for i, c in enumerate(fk.columns):
                    # The old value decides, also where another key has emptied the column.
                    cond = cond & (F.col(f"_old_{c}") == F.col(f"_fk{n}_{i}"))
                for c in fk.columns:
                    if f"_old_{c}" not in emptied.columns:
                        emptied = emptied.withColumn(f"_old_{c}", F.col(c))
                emptied = emptied.join(keys, cond, "left")
                hit = F.col(f"_fk{n}_0").isNotNull()
                if fk.on_delete == SET_NULL:
                    emptied = emptied.withColumns({c: F.when(~hit, F.col(c)) for c in fk.columns})
                    touched = touched | hit
                elif any_row(emptied.where(hit)):
                    raise Restricted(f"{fk.child} still references rows of {fk.parent} that would go")
            if name not in gone and emptied is table:
                continue
            columns = table.columns
            removed = gone[name].select(*columns) if name in gone else table.limit(0)
            changed = emptied.where(touched)
            was = lambda c: F.col(f"_old_{c}") if f"_old_{c}" in emptied.columns else F.col(c)
            pair = F.array(F.struct(*[was(c).alias(c) for c in columns], F.lit(-1).alias(SIGN)),
                           F.struct(*columns, F.lit(1).alias(SIGN)))
            delta = removed.withColumn(SIGN, F.lit(-1)).unionByName(changed.select(F.inline(pair)))
            out[name] = DmlResult(emptied.select(*columns), removed, None, delta)
        return out

    # --------------------------------------------------------- update

    def update_keys(self, table: str, column: str, key_map: DataFrame, old: str = "old_key",
                    new: str = "new_key") -> dict[str, DmlResult]:
        """``UPDATE table SET column = new WHERE column = old`` with what follows from it.

        A referencing column that is itself referenced carries the change on.
        ``key_map`` gives each old value one new value.
        """
        pairs = key_map.select(F.col(old).alias("_old"), F.col(new).alias("_new")).where(F.col("_old").isNotNull())
        if any_row(pairs.groupBy("_old").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)):
            raise ValueError("a key stands twice in the map of new keys")
        pairs = _written(pairs, "cascade-map")
        # The columns that take the new values, in the order in which the walk reaches them, and those that lose theirs.
        moved, emptied, waiting = [], [], [(table, column)]
        while waiting:
            at = waiting.pop(0)
            if at in moved:
                continue
            moved.append(at)
            for fk in self.foreign_keys:
                if fk.parent != at[0] or at[1] not in fk.references:
                    continue
                if len(fk.columns) != 1:
                    raise NotImplementedError("key updates follow foreign keys of one column")
                target = (fk.child, fk.columns[0])
                if fk.on_update == CASCADE:
                    waiting.append(target)
                elif fk.on_update == SET_NULL:
                    emptied.append(target)
                elif any_row(self.tables[fk.child].join(pairs, F.col(fk.columns[0]) == F.col("_old"), "left_semi")):
                    raise Restricted(f"{fk.child} references rows of {fk.parent} whose key would change")
        out: dict[str, DmlResult] = {}
        for name in dict.fromkeys(t for t, _ in [*moved, *emptied]):
            df, hit, values, was = self.tables[name], F.lit(False), {}, {}
            for n, c in enumerate(dict.fromkeys(c for t, c in [*moved, *emptied] if t == name)):
                key = pairs.select(F.col("_old").alias(f"_o{n}"), F.col("_new").alias(f"_n{n}"))
                df = df.join(key, F.col(c) == F.col(f"_o{n}"), "left")
                found = F.col(f"_o{n}").isNotNull()
                to = F.col(f"_n{n}") if (name, c) in moved else F.lit(None)
                values[c] = F.when(found, to).otherwise(F.col(c)).cast(self.tables[name].schema[c].dataType)
                hit = hit | found
            columns = self.tables[name].columns
            now = [values.get(c, F.col(c)).alias(c) for c in columns]
            pair = F.array(F.struct(*columns, F.lit(-1).alias(SIGN)), F.struct(*now, F.lit(1).alias(SIGN)))
            out[name] = DmlResult(df.select(*now), df.where(hit).select(*now), None, df.where(hit).select(F.inline(pair)))
        return out
