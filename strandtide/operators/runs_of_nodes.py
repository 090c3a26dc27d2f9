"""Parsimony inside a task: runs of nodes with one child each, and the few nodes that are left of a tree (`parsimony`).

Inside a run, states are bits of an integer in the order of the alphabet, so the first of a set is its lowest bit. A function is
a list of cases (a, c, b) as in `parsimony`, with None for the `a` that always holds and ALL for the `b` of everything.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ALL = -1
IDENTITY = [(None, 0, ALL)]


def of_votes(votes: list[tuple[int, int]], own: int) -> list[tuple]:
    """The cases of a node from (state, n) of the finished children and its own states."""
    most = max((n for _, n in votes), default=0)
    if not most:
        return [(None, own, ALL)]
    top = next_ = 0
    for bit, n in votes:
        if n == most:
            top |= bit
        elif n == most - 1:
            next_ |= bit
    return [(top, own, top), (None, top | own, next_ if most > 1 else ALL)]


def applied(cases: list[tuple], states: int) -> int:
    for a, c, b in cases:
        if a is None or a & states:
            return c | (states & b)
    raise ValueError("no case holds")


def composed(outer: list[tuple], inner: list[tuple]) -> list[tuple]:
    """The cases of `outer` after `inner`; one case if they always give the same."""
    out, seen = [], 0
    for a, c, b in inner:
        for s_a, s_c, s_b in outer:
            holds = a if s_a is None or c & s_a else b & s_a
            states, passed = s_c | (c & s_b), b & s_b
            if holds is None:
                out.append((None, states, passed if passed == ALL else passed & ~states))
                break
            fresh = holds & ~seen
            if not fresh:
                continue
            seen |= fresh
            passed = passed if passed == ALL else passed & ~(seen ^ fresh)
            if not fresh & (fresh - 1):
                # the child has this state
                states, passed = states | (fresh & passed), 0
            out.append((fresh, states, passed if passed == ALL else passed & ~states))
        else:
            continue
        break
    if all(b == 0 and c == out[0][1] for _, c, b in out):
        return [(None, out[0][1], 0)]
    return out


def _steps(row: dict, bit: dict[str, int]) -> dict[int, list[tuple]]:
    """The function of each member that has one, by its place."""
    told: dict[int, list[tuple]] = {}
    for pos, state, n, own in row["entries"]:
        told.setdefault(pos, []).append((bit[state], n, own))
    single: dict[tuple, list[tuple]] = {}
    out = {}
    for pos, all_ in told.items():
        if len(all_) > 1:
            out[pos] = of_votes([(b, n) for b, n, _ in all_ if n], sum(b for b, _, own in all_ if own))
        elif all_[0] in single:
            out[pos] = single[all_[0]]
        else:
            b, n, own = all_[0]
            out[pos] = single[all_[0]] = of_votes([(b, n)] if n else [], b if own else 0)
    mask = lambda states: sum(bit[s] for s in states)
    for e in row["funcs"] or ():
        out[e["pos"]] = [(None if r["a"] is None else mask(r["a"]), mask(r["c"]), ALL if r["b"] is None else mask(r["b"])) for r in e["f"]]
    return out


def _letters(row: dict) -> list[str]:
    """All states that a row names, in order."""
    named = {state for _, state, _, _ in row["entries"]}
    for e in row["funcs"] or ():
        for r in e["f"]:
            named.update(r["a"] or (), r["c"], r["b"] or ())
    named.update(row.get("below") or ())
    for t in row.get("tables") or ():
        held = dict(t["held"])
        named.update([t["other"]], held, held.values())
    if row.get("above") is not None:
        named.add(row["above"])
    return sorted(named)


def _named(mask: int, letters: list[str]) -> list[str]:
    out = []
    while mask:
        low = mask & -mask
        out.append(letters[low.bit_length() - 1])
        mask ^= low
    return out


def _bounds(column: pa.Array) -> list[int]:
    """Where each row's list begins in the flattened column, and its length."""
    return np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))).tolist()


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
    """Parts of batches and their rows; the long lists `entries` and `nodes` are read as columns."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            part = batch.slice(lo, 2048)
            said = part.column("entries")
            pos, state, n, own = said.flatten().flatten()
            state = state.dictionary_encode()
            names = state.dictionary.to_pylist()
            entries = list(zip(pos.to_numpy().tolist(), [names[c] for c in state.indices.to_numpy().tolist()], n.to_numpy().tolist(), own.to_numpy(zero_copy_only=False).tolist(), strict=True))
            at = _bounds(said)
            rows = part.drop_columns([c for c in ("entries", "nodes") if c in part.schema.names]).to_pylist()
            size = np.diff(_bounds(part.column("nodes"))).tolist() if "nodes" in part.schema.names else [0] * len(rows)
            for i, row in enumerate(rows):
                row["entries"], row["size"] = entries[at[i] : at[i + 1]], size[i]
            yield part, rows


def _ready(row: dict) -> tuple[list[str], dict[str, int], dict]:
    letters = _letters(row)
    bit = {s: 1 << i for i, s in enumerate(letters)}
    return letters, bit, _steps(row, bit)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str], dict[str, int], dict]]:
    for _, rows in _parts(batches):
        for row in rows:
            yield row, *_ready(row)


_F = pa.list_(pa.struct([(x, pa.list_(pa.string())) for x in "acb"]))


def _batched(rows: Iterator[tuple], names: list[str], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(x, types.get(n)) for n, x in zip(names, zip(*held, strict=True), strict=True)], names=names)

    for row in rows:
        held.append(row)
        if len(held) >= 20_000:
            yield batch()
            held = []
    if held:
        yield batch()


def run_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, _site, f): each run as one function of the child below it, from (run, _site, entries, funcs)."""

    def made():
        for row, letters, _, steps in _rows(batches):
            cases = IDENTITY
            for pos in sorted(steps, reverse=True):
                if len(cases) == 1 and cases[0][2] == 0:
                    cases = [(None, applied(steps[pos], cases[0][1]), 0)]
                else:
                    cases = composed(steps[pos], cases)
            lists = [{"a": None if a is None else _named(a, letters), "c": _named(c, letters), "b": None if b == ALL else _named(b, letters)} for a, c, b in cases]
            yield row["run"], row["_site"], lists

    return _batched(made(), ["node", "_site", "f"], {"_site": pa.int64(), "f": _F})


def _sets(row: dict, bit: dict[str, int], steps: dict) -> list[int]:
    """The states of the members, from above, given those of the child below."""
    states = sum(bit[s] for s in row["below"] or ())
    out = [0] * row["size"]
    for pos in range(len(out) - 1, -1, -1):
        if pos in steps:
            states = applied(steps[pos], states)
        out[pos] = states
    return out


def run_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, _site, states) of the members of each run."""

    def made():
        for part, rows in _parts(batches):
            for i, row in enumerate(rows):
                letters, bit, steps = _ready(row)
                for node, states in zip(part.column("nodes")[i].as_py(), _sets(row, bit, steps), strict=True):
                    if states:
                        yield node, row["_site"], _named(states, letters)

    return _batched(made(), ["node", "_site", "states"], {"_site": pa.int64(), "states": pa.list_(pa.string())})


def _tables(row: dict, bit: dict[str, int]) -> dict[int, tuple[int, dict[int, int]]]:
    return {t["pos"]: (bit[t["other"]], {bit[a]: bit[b] for a, b in t["held"]}) for t in row["tables"] or ()}


def run_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, _site, other, held): the state of a run's last member for each state above the run, `other` for all that are not in `held`."""

    def made():
        for row, letters, bit, steps in _rows(batches):
            inner = _tables(row, bit)
            other, held = 0, {}
            for pos, states in enumerate(_sets(row, bit, steps)):
                if not states:
                    break
                if pos in inner:
                    rest, known = inner[pos]
                    step = lambda v, known=known, rest=rest: known.get(v, rest)
                    fresh = known
                else:
                    step = lambda v, states=states: v if v & states else states & -states
                    fresh = None
                if pos:
                    held = {a: step(b) for a, b in held.items()}
                    other = step(other)
                else:
                    held = dict(known) if fresh is not None else {1 << i: 1 << i for i in range(states.bit_length()) if states >> i & 1}
                    other = rest if fresh is not None else states & -states
                held = {a: b for a, b in held.items() if b != other}
            name = lambda b: letters[b.bit_length() - 1]
            yield row["run"], row["_site"], name(other), [(name(a), name(b)) for a, b in held.items()]

    return _batched(made(), ["node", "_site", "other", "held"], {"_site": pa.int64(), "other": pa.string(), "held": pa.map_(pa.string(), pa.string())})


def run_choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, _site, above, state) of the members of each run, from the state above the run; a run's own state is its last member's."""
    for part, rows in _parts(batches):
        codes: dict[str | None, int] = {None: 0}
        at, places, counts, above, states = 0, [], [], [], []
        for row in rows:
            letters, bit, steps = _ready(row)
            inner = _tables(row, bit)
            code = {1 << i: codes.setdefault(s, len(codes)) for i, s in enumerate(letters)} | {0: 0}
            now = 0 if row["above"] is None else bit[row["above"]]
            done = 0
            for held in _sets(row, bit, steps):
                if not held:
                    break
                above.append(code[now])
                if done in inner:
                    now = inner[done][1].get(now, inner[done][0])
                elif not now & held:
                    now = held & -held
                states.append(code[now])
                done += 1
            places.append(np.arange(at, at + done))
            counts.append(done)
            at += row["size"]
        if not states:
            continue
        named = lambda x, names=list(codes): pa.DictionaryArray.from_arrays(pa.array(x, pa.int32()), pa.array(names, pa.string())).cast(pa.string())
        nodes = part.column("nodes").flatten().take(pa.array(np.concatenate(places)))
        sites = np.repeat(part.column("_site").to_numpy(), counts)
        yield pa.RecordBatch.from_arrays([nodes, pa.array(sites), named(above), named(states)], names=["node", "_site", "above", "state"])


def cell_sets(order: list[tuple]):
    """(node, _site, states) of the nodes that are left, `order` names them from above; a group is all that one site says."""

    def run(key, table):
        said: dict = {}
        funcs: dict = {}
        for row in table.to_pylist():
            if row["state"] is None:
                funcs[row["node"]] = row["f"]
            else:
                said.setdefault(row["node"], []).append((row["state"], row["n"], row["own"]))
        below: dict = {}
        nodes, sets = [], []
        for node, up, is_run in reversed(order):
            votes = below.pop(node, Counter())
            if is_run:
                for state, _, _ in said.get(node, ()):
                    votes[state] = 1
                states = set(votes)
                if node in funcs:
                    case = next(r for r in funcs[node] if r["a"] is None or not states.isdisjoint(r["a"]))
                    states = set(case["c"]) | (states if case["b"] is None else states.intersection(case["b"]))
            else:
                own = set()
                for state, n, is_own in said.get(node, ()):
                    votes[state] += n
                    if is_own:
                        own.add(state)
                most = max(votes.values(), default=0)
                states = {s for s, n in votes.items() if n == most and n} | own
            if states:
                nodes.append(node)
                sets.append(sorted(states))
                if up is not None:
                    below.setdefault(up, Counter()).update(states)
        return pa.table({"node": pa.array(nodes, pa.string()), "_site": pa.array([key[0].as_py()] * len(nodes), pa.int64()), "states": pa.array(sets, pa.list_(pa.string()))}) if nodes else _no_rows(table, [("states", pa.list_(pa.string()))])

    return run


def _no_rows(table: pa.Table, more: list[tuple]) -> pa.Table:
    return pa.schema([("node", table.schema.field("node").type), ("_site", pa.int64()), *more]).empty_table()


def cell_choices(order: list[tuple]):
    """(node, _site, above, state) of the nodes that are left, from (node, _site, states, other, held)."""

    def run(key, table):
        known = {row["node"]: row for row in table.to_pylist()}
        chosen: dict = {}
        out: list[tuple] = []
        for node, up, _ in order:
            row = known.get(node)
            if row is None:
                continue
            above = chosen.get(up)
            if row["other"] is not None:
                chosen[node] = dict(row["held"]).get(above, row["other"])
            else:
                chosen[node] = above if above in row["states"] else min(row["states"])
            out.append((node, above, chosen[node]))
        if not out:
            return _no_rows(table, [("above", pa.string()), ("state", pa.string())])
        nodes, above, states = zip(*out, strict=True)
        return pa.table({"node": pa.array(nodes, pa.string()), "_site": pa.array([key[0].as_py()] * len(out), pa.int64()), "above": pa.array(above, pa.string()), "state": pa.array(states, pa.string())})

    return run
