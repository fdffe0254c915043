"""The simulated bank's changes written into real databases, over any DB-API connection, and a check that capture keeps up."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import Any

from tidemark.simulate import Bank, Change

#: Changes between commits.
COMMIT_EVERY = 50


class NotCaptured(RuntimeError):
    """A heartbeat didn't come back in time: the source's capture job stands still."""


def statement(change: Change, key: str, mark: str = "?") -> tuple[str, tuple] | None:
    """SQL with parameters for a logged change; None for the row before an update, which its successor carries out."""
    row = change.row
    names = list(row)
    if change.code == 2:
        return f"INSERT INTO {change.table} ({', '.join(names)}) VALUES ({', '.join([mark] * len(names))})", tuple(row.values())
    if change.code == 1:
        return f"DELETE FROM {change.table} WHERE {key} = {mark}", (row[key],)
    if change.code == 4:
        rest = [n for n in names if n != key]
        return f"UPDATE {change.table} SET {', '.join(f'{n} = {mark}' for n in rest)} WHERE {key} = {mark}", (*(row[n] for n in rest), row[key])
    return None


def apply_log(connection: Any, changes: Iterable[Change], adapt: Callable[[Any], Any] = lambda v: v, mark: str = "?", every: int = COMMIT_EVERY) -> int:
    """Carries out the changes in order, committing every so many, and returns their number. adapt: values as the driver wants them."""
    cursor, n = connection.cursor(), 0
    for change in changes:
        made = statement(change, Bank._keys[change.table], mark)
        if made is None:
            continue
        cursor.execute(made[0], tuple(map(adapt, made[1])))
        n += 1
        if n % every == 0:
            connection.commit()
    connection.commit()
    return n


def replace_rows(connection: Any, table: str, key: str, rows: dict[Any, dict[str, Any]], adapt: Callable[[Any], Any] = lambda v: v, mark: str = "?") -> None:
    """Makes a table that keeps no log (loans) hold exactly these rows, touching only those that differ."""
    cursor = connection.cursor()
    names = list(next(iter(rows.values()), {key: None}))
    cursor.execute(f"SELECT {', '.join(names)} FROM {table}")
    have = {r[names.index(key)]: tuple(r) for r in cursor.fetchall()}
    for k in have.keys() - rows.keys():
        cursor.execute(f"DELETE FROM {table} WHERE {key} = {mark}", (k,))
    for k, row in rows.items():
        values = tuple(adapt(row[n]) for n in names)
        if k not in have:
            cursor.execute(f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join([mark] * len(names))})", values)
        elif have[k] != values:
            cursor.execute(f"UPDATE {table} SET {', '.join(f'{n} = {mark}' for n in names)} WHERE {key} = {mark}", (*values, k))
    connection.commit()


def heartbeat(beat: Callable[[], Any], seen: Callable[[Any], bool], timeout: float = 120.0, every: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> float:
    """Makes a change at the source and waits until its capture shows it. Seconds it took; NotCaptured after the timeout."""
    began, token = clock(), beat()
    while not seen(token):
        if clock() - began >= timeout:
            raise NotCaptured(f"nothing captured for {timeout:.0f} s")
        sleep(every)
    return clock() - began
