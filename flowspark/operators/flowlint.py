"""Rules about the graph for many small flows at once.

The rules of :mod:`flowspark.operators.lint` are joins on (flow, step), so that one huge flow
spreads over the cluster; a corpus of small flows then goes through some sixty shuffles. Here
the rows of whole flows meet in one task, and every rule is worked out over a chunk of
flows at once, by numbers in place of names. Rules and findings are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes of the flows that are worked on together.
CHUNK_ROWS, CHUNK_BYTES = 1 << 16, 64 << 20
#: Marks, one for each step and fact of a flow, that are held at a time where there are several flows.
MARKS = 1 << 26


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole flows, of rows that come sorted by flow."""
    kept: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            table = pa.Table.from_batches(kept).combine_chunks()
            start = int(_starts(_codes([table["flow"]])[0])[-1])
            if start:
                yield table.slice(0, start)
            kept = table.slice(start).combine_chunks().to_batches()
            rows, size = table.num_rows - start, sum(b.nbytes for b in kept)
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _codes(columns: list) -> list[np.ndarray]:
    """Equal values of the columns, together, as equal numbers."""
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    every = pa.chunked_array(columns).combine_chunks().dictionary_encode()
    every = every.combine_chunks() if isinstance(every, pa.ChunkedArray) else every
    numbers = every.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(numbers, np.cumsum([len(c) for c in columns])[:-1])


def _starts(sorted_codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_codes[1:] != sorted_codes[:-1]))


def _list(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """Values of a list column and the row of each."""
    lists = table[name].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _last(group: np.ndarray, place: np.ndarray, groups: int) -> np.ndarray:
    """The row of greatest place of each group."""
    order = np.lexsort((place, group))
    out = np.zeros(groups, np.int64)
    out[group[order]] = order
    return out


def _within(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, found) of values in a sorted array."""
    if not len(known):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return at, known[at] == values


class Children:
    """Links (child, parent), found by parent."""

    def __init__(self, child: np.ndarray, parent: np.ndarray, nodes: int):
        order = np.argsort(parent, kind="stable")
        self.child = child[order]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=nodes))])

    def of(self, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``parents``, child) of each link."""
        first, n = self.start[parents], self.start[parents + 1] - self.start[parents]
        of = np.repeat(np.arange(len(parents)), n)
        return of, self.child[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of]]


def _unplaced(child: np.ndarray, parent: np.ndarray, nodes: int) -> np.ndarray:
    """Nodes on or behind a cycle: what is left when nodes without open parents are taken away."""
    need = np.bincount(child, minlength=nodes)
    below, ready = Children(child, parent, nodes), np.flatnonzero(need == 0)
    while len(ready):
        _, met = below.of(ready)
        np.subtract.at(need, met, 1)
        met = np.unique(met)
        ready = met[need[met] == 0]
    return np.flatnonzero(need > 0)


def findings(table: pa.Table, rules: set[str]) -> Iterator[pa.RecordBatch]:
    """Findings of whole flows whose rows follow each other."""
    flow = _codes([table["flow"]])[0]
    first_rows = _starts(flow)
    flow = np.repeat(np.arange(len(first_rows)), np.diff(np.append(first_rows, len(flow))))
    parents, parent_row = _list(table, "parents")
    names = table["name"].combine_chunks()
    name, parent_name = _codes([names, parents])
    width = int(max(name.max(initial=0), parent_name.max(initial=0))) + 1
    keys, a_row, node = np.unique(flow * width + name, return_index=True, return_inverse=True)
    nodes, flow_of = len(keys), keys // width

    # edges: (child, parent as a number of its own), with the parent's node where it is known
    above, above_at, number = np.unique(flow[parent_row] * width + parent_name, return_index=True, return_inverse=True)
    pairs = np.unique(node[parent_row] * max(len(above), 1) + number)
    child, above_of = pairs // max(len(above), 1), pairs % max(len(above), 1)
    at, is_node = _within(above, keys)
    known = is_node[above_of] if len(above) else np.zeros(0, bool)
    link_child, link_parent = child[known], at[above_of[known]]
    links = np.sort(link_child * nodes + link_parent)
    feeds = np.zeros(nodes, bool)
    feeds[link_parent] = True
    last = _last(node, table["pos"].to_numpy(), nodes)

    # reads of views: a view belongs to the last step that makes it
    targets, target_row = _list(table, "targets")
    view, target = _codes([table["view"], _list(table, "target_views")[0]])
    wide = int(max(view.max(initial=0), target.max(initial=0))) + 1
    views, view_of = np.unique(flow * wide + view, return_inverse=True)
    owner = node[_last(view_of, table["pos"].to_numpy(), len(views))]
    at_view, is_view = _within(flow[target_row] * wide + target, views)
    read = np.unique(node[target_row[is_view]] * len(views) + at_view[is_view])
    a_view = np.zeros(len(views), np.int64)
    a_view[view_of] = np.arange(len(view_of))
    reader, what = read // len(views), read % len(views)
    other = owner[what] != reader
    reader, what = reader[other], what[other]
    read_links = reader * nodes + owner[what]
    indirect = ~np.isin(read_links, links)
    reader, what = reader[indirect], what[indirect]

    # facts that are carried downstream: a number for each that a flow has, of whatever kind
    null_filters, filter_row = _list(table, "filters")
    sources, source_row = _list(table, "sources")
    summed, summed_row = _list(table, "summed")
    filter_fact, source_fact, summed_fact = _codes([null_filters, sources, summed])
    kind = int(max((int(x.max(initial=0)) for x in (filter_fact, source_fact, summed_fact)), default=0)) + 1
    fact_width = 2 * kind + nodes
    fact_node = np.concatenate([node[filter_row], node[source_row], owner[what]])
    fact_key = flow_of[fact_node] * fact_width + np.concatenate([filter_fact, kind + source_fact, 2 * kind + owner[what]])
    facts, fact = np.unique(fact_key, return_inverse=True)
    flows = len(first_rows)
    n_nodes, n_facts = np.bincount(flow_of, minlength=flows), np.bincount(facts // fact_width, minlength=flows)
    marks = n_nodes * n_facts
    if marks.sum() > MARKS and flows > 1:
        half = min(max(int(np.searchsorted(np.cumsum(marks), marks.sum() // 2)), 1), flows - 1)
        yield from findings(table.slice(0, int(first_rows[half])).combine_chunks(), rules)
        yield from findings(table.slice(int(first_rows[half])).combine_chunks(), rules)
        return
    base = np.cumsum(marks) - marks
    first_node, first_fact = np.cumsum(n_nodes) - n_nodes, np.cumsum(n_facts) - n_facts

    def mark(n: np.ndarray, f: np.ndarray) -> np.ndarray:
        g = flow_of[n]
        return base[g] + (n - first_node[g]) * n_facts[g] + f - first_fact[g]

    carried, own = np.zeros(int(marks.sum()), bool), np.zeros(int(marks.sum()), bool)
    own[mark(fact_node, fact)] = True
    below = Children(link_child, link_parent, nodes)
    fresh = np.unique(mark(fact_node, fact), return_index=True)[1]
    now, now_fact = fact_node[fresh], fact[fresh]
    while len(now):
        of, met = below.of(now)
        met_fact = now_fact[of]
        places = mark(met, met_fact)
        new = np.flatnonzero(~carried[places])
        new = new[np.unique(places[new], return_index=True)[1]]
        carried[places[new]] = True
        now, now_fact = met[new], met_fact[new]

    def inherited(n: np.ndarray, f: np.ndarray) -> np.ndarray:
        return carried[mark(n, f)]

    def strings(column: pa.Array, rows: np.ndarray) -> pa.Array:
        return column.take(pa.array(rows))

    def at_rows(rows: np.ndarray, detail: pa.Array | str) -> tuple:
        return rows, strings(names, rows), detail

    def at_nodes(n: np.ndarray, detail: pa.Array | str) -> tuple:
        return at_rows(a_row[n], detail)

    def parent_of(n: np.ndarray) -> pa.Array:
        return strings(names, a_row[n])

    def duplicate_step() -> tuple:
        n = np.bincount(node, minlength=nodes)
        twice = np.flatnonzero(n > 1)
        return at_nodes(twice, pa.array(n[twice]).cast(pa.string()))

    def unknown_parent() -> tuple:
        return at_nodes(child[~known], strings(parents, above_at[above_of[~known]]))

    def cycle() -> tuple:
        valid = (last[node[parent_row]] == parent_row) & (is_node[number] if len(above) else np.zeros(0, bool))
        both = np.unique(node[parent_row[valid]] * nodes + at[number[valid]])
        return at_nodes(_unplaced(both // nodes, both % nodes, nodes), "on or behind a cycle")

    def orphan_step() -> tuple:
        alone = (np.bincount(parent_row, minlength=len(flow)) == 0) & ~feeds[node] & (np.bincount(flow, minlength=flows)[flow] > 1)
        return at_rows(np.flatnonzero(alone), "no parents and no children")

    def view_not_upstream() -> tuple:
        bad = ~inherited(reader, fact[len(fact) - len(reader):])
        return at_nodes(reader[bad], strings(table["view"].combine_chunks(), a_view[what[bad]]))

    def unread_parent() -> tuple:
        bad = ~np.isin(link_child * nodes + link_parent, read_links)
        return at_nodes(link_child[bad], parent_of(link_parent[bad]))

    def order_not_after_parent() -> tuple:
        order = table["ord"].to_numpy()[last]
        bad = order[link_child] <= order[link_parent]
        return at_nodes(link_child[bad], parent_of(link_parent[bad]))

    def hardcoded_table() -> tuple:
        return at_rows(target_row[~is_view], targets.filter(pa.array(~is_view)))

    def early_target() -> tuple:
        stored = table["target_table"].combine_chunks()
        early = pc.not_equal(stored, "").to_numpy(zero_copy_only=False) & (feeds[node] | ~pc.starts_with(names, "SAVE_").to_numpy(zero_copy_only=False))
        rows = np.flatnonzero(early)
        return at_rows(rows, strings(stored, rows))

    def inactive_parent() -> tuple:
        active = table["active"].to_numpy()[last].astype(bool)
        bad = ~active[link_parent] & active[link_child]
        return at_nodes(link_child[bad], parent_of(link_parent[bad]))

    def repeated_null_filter() -> tuple:
        bad = inherited(node[filter_row], fact[: len(filter_row)])
        return at_rows(filter_row[bad], null_filters.filter(pa.array(bad)))

    def repeated_source() -> tuple:
        bad = inherited(node[source_row], fact[len(filter_row) : len(filter_row) + len(source_row)])
        return at_rows(source_row[bad], sources.filter(pa.array(bad)))

    def unsafe_aggregate() -> tuple:
        at_fact, is_fact = _within(flow[summed_row] * fact_width + summed_fact, facts)
        bad = np.ones(len(summed_row), bool)
        places = mark(node[summed_row[is_fact]], at_fact[is_fact])
        bad[is_fact] = ~(own[places] | carried[places])
        return at_rows(summed_row[bad], summed.filter(pa.array(bad)))

    each: list[Callable[[], tuple]] = [
        duplicate_step, unknown_parent, cycle, orphan_step, view_not_upstream, unread_parent, order_not_after_parent, hardcoded_table,
        early_target, inactive_parent, repeated_null_filter, repeated_source, unsafe_aggregate,
    ]
    for rule in each:
        if rule.__name__ in rules:
            rows, step, detail = rule()
            if len(rows):
                detail = pa.repeat(detail, len(rows)) if isinstance(detail, str) else detail
                yield pa.RecordBatch.from_arrays(
                    [table["flow"].combine_chunks().take(pa.array(rows)), step, pa.repeat(rule.__name__, len(rows)), detail],
                    names=["flow", "step", "rule", "detail"],
                )
