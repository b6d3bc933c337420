"""Record-by-record replays in plain Python, to check the folds against."""

from __future__ import annotations

import random


def random_log(seed: int, keys: int, records: int, columns: tuple[str, ...], hot: str | None = None):
    """Log records ``(ms, n, pk, op, {column: text})``, ids ascending, several per millisecond."""
    rnd = random.Random(seed)
    out, ms, n = [], 1000, 0
    for i in range(records):
        if rnd.random() < 0.6:
            ms, n = ms + rnd.randint(1, 3), 0
        else:
            n += 1
        pk = hot if hot and rnd.random() < 0.4 else str(rnd.randrange(keys))
        op = rnd.choice("===~")
        cols = {c: f"{c}{i}" for c in columns} if op == "=" else {}
        out.append((ms, n, pk, op, cols))
    return out


def merge(target: dict[str, dict], log, columns, replace: bool = False) -> dict[str, dict]:
    rows = {k: dict(v) for k, v in target.items()}
    for _, _, pk, op, cols in log:
        if op == "~":
            rows.pop(pk, None)
        elif replace:
            rows[pk] = {c: cols[c] for c in columns}
        else:
            rows.setdefault(pk, {}).update(cols)
    return rows


def merge_fields(target: dict[str, dict], log) -> dict[str, dict]:
    rows = {k: dict(v) for k, v in target.items()}
    for _, _, pk, op, fields in log:
        if op == "~":
            rows.pop(pk, None)
        else:
            rows.setdefault(pk, {}).update(fields)
    return rows


def fits(text: str | None, kind: str) -> bool:
    if text is None:
        return False
    if kind == "string":
        return True
    try:
        int(text)
        return True
    except ValueError:
        return False


def write_through(source: dict[str, dict], staged, fields: dict[str, str], kinds: dict[str, str]):
    """Staged writes one after the other: source, target rows and the outcome of each."""
    state = {k: dict(v) for k, v in source.items()}
    target: dict[str, dict] = {}
    outcome = []
    for ms, n, key, op, values in staged:
        pk = key.split(":")[1]
        if op in "~-":
            state.pop(key, None)
            if op == "~":
                target.pop(pk, None)
            outcome.append((ms, n, key, True))
            continue
        over = {**state.get(key, {}), **values}
        done = op == "+" or all(fits(over.get(s), kinds.get(c, "string")) for s, c in fields.items())
        if done:
            state[key] = over
            if op == "=":
                target[pk] = {c: over[s] for s, c in fields.items()}
        outcome.append((ms, n, key, done))
    return state, target, outcome
