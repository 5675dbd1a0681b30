"""Structured Streaming jobs with keyed state: observation intake, a ledger of reservations and guarded snapshots.

Each handler takes the rows of its key that arrived together in the order of an
explicit sequence column, so that outcomes do not depend on the order of arrival within
a micro-batch; state per key is a few scalars.  With ``idle_hours`` the state of
a key that nothing reached for so long is given up, and the key begins anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _keyed(stream: DataFrame, keys: list[str], columns: list[str], sequence: str, step: Callable[..., tuple[tuple, tuple]], output: str, state: str, idle_hours: float | None) -> DataFrame:
    """Rows (sequence, output) of step(state or None, *values of columns), which returns the next state and the row's output.

    Values reach ``step`` as strings or None, as Arrow to pandas would make floats of whole numbers beside nulls.
    The rows of a key in one micro-batch are held together, to be put in order; bound them with ``maxFilesPerTrigger``.
    """
    names = [sequence, *(c.split()[0] for c in output.split(", "))]

    def handle(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        rows = pd.concat(list(frames)).sort_values(sequence, kind="stable")
        now, out = held.get if held.exists else None, []
        for seq, *values in zip(rows[sequence].tolist(), *(rows[c].tolist() for c in columns)):
            now, told = step(now, *(v if isinstance(v, str) else None for v in values))
            out.append((seq, *told))
        held.update(now)
        if idle_hours:
            held.setTimeoutDuration(int(idle_hours * 3_600_000))
        yield pd.DataFrame(out, columns=names)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_hours else GroupStateTimeout.NoTimeout
    grouped = stream.select(*keys, sequence, *[F.col(c).cast("string").alias(c) for c in columns]).groupBy(*keys)
    return grouped.applyInPandasWithState(handle, f"{sequence} long, {output}", state, "append", timeout)


def _amount(text: str | None) -> Decimal | None:
    """An exact amount; None for null, negative and what is no finite number."""
    try:
        value = Decimal(text) if text is not None else None
    except InvalidOperation:
        return None
    return value if value is not None and value.is_finite() and value >= 0 else None


def intake(stream: DataFrame, keys: list[str], sequence: str, payload: str, idle_hours: float | None = None) -> DataFrame:
    """(sequence, outcome): the first row of an identity is 'stored', an equal payload later is 'noop', another is 'conflict'; null is a payload too.

    Payloads may be of any type that casts to a string that tells its values apart.
    """

    def step(now: tuple | None, value: str | None) -> tuple[tuple, tuple]:
        return ((value,), ("stored",)) if now is None else (now, ("noop" if value == now[0] else "conflict",))

    return _keyed(stream, keys, [payload], sequence, step, "outcome string", "first string", idle_hours)


AMOUNT = "decimal(38,10)"


def ledger(stream: DataFrame, account: str, sequence: str, amount: str, ceiling: Decimal | int | str, idle_hours: float | None = None) -> DataFrame:
    """(sequence, accepted, held): a reservation is accepted if it keeps the account at or under the ceiling; null and negative ones never are.

    Amounts are decimals, of ten digits after the point at most.
    """
    most = Decimal(ceiling)

    def step(now: tuple | None, text: str | None) -> tuple[tuple, tuple]:
        held, value = Decimal(now[0]) if now else Decimal(0), _amount(text)
        ok = value is not None and held + value <= most
        held += value if ok else 0
        return (str(held),), (ok, held)

    return _keyed(stream, [account], [amount], sequence, step, f"accepted boolean, held {AMOUNT}", "held string", idle_hours)


def settled_ledger(stream: DataFrame, account: str, sequence: str, action: str, amount: str, ceiling: Decimal | int | str, idle_hours: float | None = None) -> DataFrame:
    """(sequence, status, spent, held): 'reserve' holds an amount if spent and held stay at or under the ceiling, 'settle' spends
    and 'release' gives back what is held.

    status: 'accepted', 'invalid' (null, negative or not finite, or an unknown action), 'over_ceiling', 'not_held'.
    Amounts are decimals, of ten digits after the point at most.
    """
    most = Decimal(ceiling)

    def step(now: tuple | None, what: str | None, text: str | None) -> tuple[tuple, tuple]:
        spent, held = map(Decimal, now or (0, 0))
        value = _amount(text)
        if value is None or what not in ("reserve", "settle", "release"):
            status = "invalid"
        elif what == "reserve":
            status = "accepted" if spent + held + value <= most else "over_ceiling"
            held += value if status == "accepted" else 0
        elif value > held:
            status = "not_held"
        else:
            status, held = "accepted", held - value
            spent += value if what == "settle" else 0
        return (str(spent), str(held)), (status, spent, held)

    return _keyed(stream, [account], [action, amount], sequence, step, f"status string, spent {AMOUNT}, held {AMOUNT}", "spent string, held string", idle_hours)


def compare_and_set(stream: DataFrame, account: str, sequence: str, expected: str, payload: str, idle_hours: float | None = None) -> DataFrame:
    """(sequence, status): a row replaces the stored payload only if ``expected`` equals it (-1 for the first); otherwise 'stale'."""

    def step(now: tuple | None, want: str | None, value: str | None) -> tuple[tuple, tuple]:
        here = now[0] if now else "-1"
        return ((value if want == here else here,), ("updated" if want == here else "stale",))

    return _keyed(stream, [account], [expected, payload], sequence, step, "status string", "now string", idle_hours)


def snapshot_history(stream: DataFrame, account: str, sequence: str, expected: str, content: str, idle_hours: float | None = None) -> DataFrame:
    """(sequence, status, previous, current): history rows of guarded updates; expected and content are hashes.

    'updated' appends ``current`` after ``previous`` (null for the first, whose ``expected`` is null too), 'unchanged' repeats what
    is stored, 'stale' expected something else; the stored hash is then the current one.
    """

    def step(now: tuple | None, want: str | None, value: str) -> tuple[tuple, tuple]:
        here = now[0] if now else None
        if want != here:
            return (here,), ("stale", here, here)
        return (value,), ("unchanged" if value == here else "updated", here, value)

    return _keyed(stream, [account], [expected, content], sequence, step, "status string, previous string, current string", "now string", idle_hours)
