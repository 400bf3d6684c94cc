"""Execution of SQLite statements in isolated in-memory databases, distributed over Arrow batches.

The property that is tested is "valid SQLite", so the statements run in SQLite itself: one database for each Python worker and dump,
mutations inside a savepoint that is always rolled back.  A step limit ends statements that would not end.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS = 20_000_000
_MARK = "_checked_"


def _guarded(db: sqlite3.Connection, steps: int) -> None:
    if not steps:
        db.set_progress_handler(None, 0)
        return
    left = [steps // 1000]

    def tick() -> int:
        left[0] -= 1
        return left[0] < 0

    db.set_progress_handler(tick, 1000)


def database(script: str) -> sqlite3.Connection:
    db = sqlite3.connect(":memory:", isolation_level=None)
    db.execute("PRAGMA foreign_keys = ON")
    db.executescript(script)
    return db


def _reads(sql: str) -> bool:
    return sql.strip().lower().startswith(("select", "with"))


def execute(db: sqlite3.Connection, sql: str, steps: int = STEPS) -> dict:
    """success, row_count (rows read, or changed), error, column_names.  The database is as before afterwards, also after WITH ... INSERT."""
    _guarded(db, steps)
    before = db.total_changes
    try:
        db.execute(f"SAVEPOINT {_MARK}")
        try:
            cursor = db.execute(sql)
            if _reads(sql):
                rows, names = len(cursor.fetchall()), [d[0] for d in cursor.description or []]
            else:
                rows, names = max(0, db.total_changes - before), []
        finally:
            _guarded(db, STEPS)
            db.execute(f"ROLLBACK TO {_MARK}")
            db.execute(f"RELEASE {_MARK}")
        return {"success": True, "row_count": rows, "error": None, "column_names": names}
    except Exception as e:
        return {"success": False, "row_count": 0, "error": str(e), "column_names": []}


def signature(db: sqlite3.Connection, sql: str, steps: int = STEPS) -> dict:
    """kind, columns, rows (JSON texts in order) and n: what two statements must share to count as equal.  Empty text is an error."""
    empty = {"kind": None, "columns": [], "rows": [], "n": 0, "error": None}
    if not sql or not sql.strip():
        return empty | {"error": "empty SQL"}
    if not _reads(sql):
        got = execute(db, sql, steps)
        return empty | ({"kind": "mutation", "n": got["row_count"]} if got["success"] else {"error": got["error"]})
    _guarded(db, steps)
    try:
        db.execute(f"SAVEPOINT {_MARK}")
        try:
            cursor = db.execute(sql)
            rows = sorted(json.dumps(r, ensure_ascii=False, default=str) for r in cursor.fetchall())
            names = [d[0] for d in cursor.description or []]
        finally:
            db.execute(f"ROLLBACK TO {_MARK}")
            db.execute(f"RELEASE {_MARK}")
        return empty | {"kind": "rows", "columns": names, "rows": rows, "n": len(rows)}
    except Exception as e:
        return empty | {"error": str(e)}


RESULT = "struct<success:boolean,row_count:long,error:string,column_names:array<string>>"
SIGNATURE = "struct<kind:string,columns:array<string>,rows:array<string>,n:long,error:string>"


def executed(df: DataFrame, db_id: str, sql: str, dumps: dict[str, str], out: str = "result", as_signature: bool = False, steps: int = STEPS) -> DataFrame:
    """Adds the result (or signature) of each row's statement in its database.  ``dumps`` maps database ids to scripts; unknown ids and
    null statements give an error result.  A statement ends with an error after ``steps`` (0: no limit).  The scripts (given by the caller, one for each domain) are broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(dumps)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        open_: dict[str, sqlite3.Connection] = {}
        step = signature if as_signature else execute
        unknown = {"kind": None, "columns": [], "rows": [], "n": 0, "error": "unknown database"} if as_signature else {"success": False, "row_count": 0, "error": "unknown database", "column_names": []}
        for ids, texts in batches:
            rows = []
            for i, s in zip(ids, texts):
                if i not in open_ and i in shared.value:
                    open_[i] = database(shared.value[i])
                rows.append(step(open_[i], s or "", steps) if i in open_ else unknown)
            yield pd.DataFrame(rows, columns=list(unknown))

    kind = SIGNATURE if as_signature else RESULT
    return df.withColumn(out, F.pandas_udf(run, kind)(F.col(db_id), F.col(sql)))


def valid_in_context(df: DataFrame, context: str, sql: str, out: str = "error", steps: int = STEPS) -> DataFrame:
    """Adds the error of running ``sql`` in a fresh database after its own context script; null where it runs (``steps`` as in executed)."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for contexts, texts in batches:
            errors = []
            for c, s in zip(contexts, texts):
                db = sqlite3.connect(":memory:")
                _guarded(db, steps)
                try:
                    db.executescript(c or "")
                    db.execute(s or "")
                    errors.append(None)
                except Exception as e:
                    errors.append(str(e) or type(e).__name__)
                finally:
                    db.close()
            yield pd.Series(errors, dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "string")(F.col(context), F.col(sql)))
