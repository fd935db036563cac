"""Reading JSON documents inside tasks: deep trees, and the shape of landing files.

Documents that nest deeper than Python's reader allows (about 10 000 levels) become error rows.
Trees are recursive and nest deeper than Spark's own JSON readers allow, so documents are read
batch-wise in Python with an explicit stack. Everything after that is relational.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from querytrail.functions.text import RULE_MARK, TERMINAL_MARK
from querytrail.schemas import END_NAME, END_OF_FILE, NODE, PLACED, TOKEN_DEFAULTS

CHUNK = 50_000
LIST_BYTES = 1 << 20
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
_ARROW = pa.schema([(f.name, _TYPES[f.dataType.simpleString()]) for f in NODE])
_TOKEN = pa.struct([(f.name, _TYPES[f.dataType.simpleString()]) for f in PLACED[0].dataType])
_WITH_TOKENS = pa.schema([*_ARROW, *((f.name, _TOKEN) for f in PLACED)])


def tree_roots(document: Any) -> list:
    """The trees of a document in any of the four layouts."""
    if isinstance(document, list):
        return document
    return [document["parseTree"] if "parseTree" in document else document]


class _Columns:
    """What is read of the nodes of many trees, in pre-order; the shape follows from the numbers of children.

    With tokens, each document brings its token list, and its nodes get their tokens.
    """

    def __init__(self, with_tokens: bool = False) -> None:
        self.with_tokens = with_tokens
        self.types: list[str] = []
        self.texts: list[str] = []
        self.starts: list[int] = []
        self.stops: list[int] = []
        self.counts: list[int] = []
        self.files: list[str | None] = []
        self.numbers: list[int] = []
        self.roots: list[int] = []
        self.documents: list[int] = []
        self.lists: list[pa.StructArray] = []
        self.listed = 0

    def __len__(self) -> int:
        return max(len(self.types), self.listed)

    def add_document(self, file: str | None, payload: str, tokens: pa.StructArray | None = None) -> None:
        """All nodes of a document, or none where any of it can't be read.

        A document without a name has no tokens: a null key meets none.
        """
        at, trees = len(self.types), len(self.roots)
        try:
            for number, root in enumerate(tree_roots(json.loads(payload))):
                self.files.append(file)
                self.numbers.append(number)
                self.roots.append(len(self.types))
                self.documents.append(len(self.lists))
                self._add_tree(number, root)
            if tokens is not None:
                self.lists.append(tokens if file is not None else tokens[:0])
                self.listed += len(self.lists[-1])
        except Exception:
            for column in (self.types, self.texts, self.starts, self.stops, self.counts):
                del column[at:]
            for column in (self.files, self.numbers, self.roots, self.documents):
                del column[trees:]
            raise

    def _add_tree(self, number: int, root: dict) -> None:
        types, texts, starts, stops, counts = self.types, self.texts, self.starts, self.stops, self.counts
        first, limit = len(types), 1 << 31
        stack = [root]
        while stack:
            get = stack.pop().get
            children = get("children") or ()
            node_type, text = get("nodeType", ""), get("text", "")
            start, stop = get("startIndex", -1), get("stopIndex", -1)
            if not (type(node_type) is type(text) is str and type(start) is type(stop) is int
                    and -limit < start < limit and -limit < stop < limit):
                raise TypeError(f"node {len(types) - first} of tree {number} has a field of another type")
            counts.append(len(children))
            types.append(node_type)
            texts.append(text)
            starts.append(start)
            stops.append(stop)
            if children:
                stack.extend([children[i] for i in range(len(children) - 1, -1, -1)])

    def batch(self) -> pa.RecordBatch:
        """The node table of these trees."""
        n = len(self.types)
        at, counts = np.arange(n), np.array(self.counts, np.int64)
        last, depth = _ends(counts)
        # By depth and place, the children of the nodes come one after the other, in the order of the nodes.
        level = np.argsort(depth, kind="stable")
        below = counts[level]
        parent, ordinal = np.full(n, -1), np.zeros(n, np.int64)
        inner = level[len(self.roots):]
        parent[inner] = np.repeat(level, below)
        ordinal[inner] = np.arange(len(inner)) - np.repeat(np.cumsum(below) - below, below)
        sizes = np.diff(np.array([*self.roots, n]))
        tree = np.repeat(np.arange(len(sizes)), sizes)
        base = np.repeat(np.array(self.roots, np.int64), sizes)
        types = pa.array(self.types, pa.string()).dictionary_encode()
        rule = np.array([not t.startswith(TERMINAL_MARK) for t in types.dictionary.to_pylist()], bool)
        kinds = types.indices.to_numpy()
        closes = np.bincount(last[rule[kinds]], minlength=n)
        top = parent < 0
        columns = [
            pa.array(self.files, pa.string()).take(pa.array(tree)), np.array(self.numbers)[tree], at - base,
            pa.array(parent - base, mask=top), last - base, depth, ordinal, counts, closes,
            types.dictionary.take(pa.array(kinds[parent], mask=top)), types.cast(pa.string()),
            self.texts, self.starts, self.stops, pa.nulls(n, pa.string()),
        ]
        schema = _ARROW
        if self.with_tokens:
            schema = _WITH_TOKENS
            columns += self._tokens(types.dictionary.to_pylist(), kinds, tree, last)
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
            schema=schema)

    def _tokens(self, names: list[str], kinds: np.ndarray, tree: np.ndarray, last: np.ndarray) -> list[pa.Array]:
        """The tokens at which each node begins and each rule ends, by the rules of the detailed form.

        Of several tokens at one offset the one with the lowest index counts, then the first in the list.
        The first end-of-file token counts for the last end-of-file terminal of each tree and the rules that
        end with it, and nowhere else.
        """
        if not self.listed:
            return [pa.nulls(len(kinds), _TOKEN)] * 2
        sizes = [len(listed) for listed in self.lists]
        of = np.repeat(np.arange(len(sizes)), sizes)
        tokens = pa.concat_arrays(self.lists)
        # flattened, the fields of a missing token are missing too
        field = {f.name: pc.fill_null(c, TOKEN_DEFAULTS[f.name]) for f, c in zip(tokens.type, tokens.flatten(), strict=True)}
        number = {n: c.to_numpy().astype(np.int64) for n, c in field.items() if c.type == pa.int32()}
        at_end = (number["type"] == END_OF_FILE) | pc.equal(field["typeName"], END_NAME).to_numpy(zero_copy_only=False)
        plain, ends = np.flatnonzero(~at_end), np.flatnonzero(at_end)
        document = np.array(self.documents)[tree]

        def place(of: np.ndarray, offset: np.ndarray) -> np.ndarray:
            return (of << 32) + offset + (1 << 31)

        def found(name: str, offsets: list[int]) -> np.ndarray:
            """Place of the token at the offset of each node; -1 without one."""
            wanted = place(document, np.array(offsets, np.int64))
            places = place(of[plain], number[name][plain])
            order = np.lexsort((number["index"][plain], places))
            known, first = np.unique(places[order], return_index=True)
            if not len(known):
                return np.full(len(wanted), -1)
            near = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            return np.where(known[near] == wanted, plain[order][first][near], -1)

        end_token = np.full(len(sizes), -1)
        with_end, first_end = np.unique(of[ends], return_index=True)
        end_token[with_end] = ends[first_end]
        end_name = np.array([
            n.startswith(TERMINAL_MARK) and n.replace(TERMINAL_MARK, "") == END_NAME for n in names], bool)
        is_rule = np.array([n.startswith(RULE_MARK) for n in names], bool)[kinds]
        end_node, at_name = np.full(len(self.roots), -1), np.flatnonzero(end_name[kinds])
        np.maximum.at(end_node, tree[at_name], at_name)
        ends_file = last == end_node[tree]
        start = np.where(ends_file & ~is_rule, end_token[document], found("startIndex", self.starts))
        stop = np.where(ends_file, end_token[document], found("stopIndex", self.stops))
        shown = pa.StructArray.from_arrays(
            [field[n] for n in ("type", "text", "line", "column", "startIndex", "stopIndex", "index")],
            fields=list(_TOKEN))
        return [shown.take(pa.array(at, mask=at < 0)) for at in (start, np.where(is_rule, stop, -1))]


def _ends(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the last node below each node, and depth, from the numbers of children in pre-order.

    The nodes still awaited grow by the children and shrink by one with each node, so a subtree ends
    where there is first one less than before its node.
    """
    n = len(counts)
    at, waiting = np.arange(n), np.cumsum(counts - 1)
    # one number for (awaited, place); the lowest number awaited is that after the last tree
    key = (waiting - waiting[-1]) * n + at
    found = np.searchsorted(ordered := np.sort(key), (waiting - counts - waiting[-1]) * n + at)
    last = ordered[found] % n
    inside = np.ones(n + 1, np.int64)
    inside[0] = 0
    inside -= np.bincount(last + 1, minlength=n + 1)
    return last, np.cumsum(inside)[:n]


def _errors(files: list, errors: list[str], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.nulls(len(files), f.type) for f in schema]
    columns[0], columns[len(_ARROW) - 1] = pa.array(files, pa.string()), pa.array(errors, pa.string())
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _token_list(tokens: pa.ListArray, row: int) -> pa.StructArray:
    """The list of a row; an empty one where it is missing."""
    listed = tokens[row].values
    return tokens.values[:0] if listed is None else listed


def node_batches(batches: Iterator[pa.RecordBatch], with_tokens: bool = False) -> Iterator[pa.RecordBatch]:
    """(file, payload) batches -> node batches; an unreadable document gives one error row.

    With tokens there is a third column, the token list, and nodes have the columns of PLACED too.
    """
    found, files, errors = _Columns(with_tokens), [], []
    schema = _WITH_TOKENS if with_tokens else _ARROW
    for batch in batches:
        for row, (file, payload) in enumerate(zip(batch.column(0), batch.column(1), strict=True)):
            name = file.as_py()
            try:
                listed = _token_list(batch.column(2), row) if with_tokens else None
                found.add_document(name, payload.as_py(), listed)
            except Exception as problem:  # noqa: BLE001 - any bad document is reported, not fatal
                files.append(name)
                errors.append(f"{type(problem).__name__}: {problem}")
            if len(found) >= CHUNK:
                yield found.batch()
                found = _Columns(with_tokens)
            if len(files) >= CHUNK:
                yield _errors(files, errors, schema)
                files, errors = [], []
    if len(found):
        yield found.batch()
    if files:
        yield _errors(files, errors, schema)


def some_columns(names: list[str], with_tokens: bool = False) -> Callable:
    """`node_batches` that hands on these columns only: the others need not leave the Python process."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (batch.select(names) for batch in node_batches(batches, with_tokens))

    return run


def _quoted(words: pa.Array) -> pa.Array:
    """JSON texts of the words."""
    plain = words
    for mark, escaped in (("\\", "\\\\"), ('"', '\\"')):
        plain = pc.replace_substring(plain, mark, escaped)
    quoted = pc.binary_join_element_wise('"', plain, '"', "")
    control = pc.match_substring_regex(words, r"[\x00-\x1f]")
    if not pc.any(control).as_py():
        return quoted
    escaped = [json.dumps(w, ensure_ascii=False) for w in words.filter(control).to_pylist()]
    return pc.replace_with_mask(quoted, control, pa.array(escaped, pa.string()))


def _slices(rows: pa.RecordBatch, edges: list[int]) -> Iterator[pa.RecordBatch]:
    return (rows.slice(start, stop - start) for start, stop in zip(edges, edges[1:], strict=False) if stop > start)


def token_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, text) batches -> (file, payload): the words between single blanks as a token list."""
    for batch in batches:
        # lists take some thirty times the place of their texts, so a batch is cut by size
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // LIST_BYTES)) + 1
        for part in _slices(batch, [0, *cuts.tolist(), batch.num_rows]):
            split = pc.split_pattern(part.column(1), " ")
            words, counts = split.flatten(), pc.fill_null(pc.list_value_length(split), 0).to_numpy()
            first = np.cumsum(counts) - counts
            no = np.arange(len(words)) - np.repeat(first, counts)
            size = pc.utf8_length(words).to_numpy()
            text = lambda numbers: pa.array(numbers).cast(pa.string())
            kind = text(size % 7)
            tokens = pc.binary_join_element_wise(
                '{"index":', text(no), ',"type":', kind, ',"typeName":"T', kind, '","text":', _quoted(words),
                ',"startIndex":', text(no * 100), ',"stopIndex":', text(no * 100 + size - 1),
                ',"line":', text(no // 10 + 1), ',"column":', text(no % 10), "}", "")
            listed = pa.ListArray.from_arrays(pa.array([*first, len(words)], pa.int32()), tokens)
            inner = pc.binary_join_element_wise('{"tokenStream":[', pc.binary_join(listed, ","), "]}", "")
            payload = pc.if_else(split.is_null(), "{}", inner)
            yield pa.RecordBatch.from_arrays([part.column(0), payload], names=["file", "payload"])


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; null is a value like any other."""
    if column.null_count == len(column):
        return np.zeros(len(column) - 1, bool)
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.not_equal(here, before).fill_null(False).to_numpy(zero_copy_only=False)
    if not column.null_count:
        return other
    return other | pc.not_equal(here.is_null(), before.is_null()).to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of sorted batches as one table."""
    begun: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            cut |= _changes(batch.column(key))
        table = pa.Table.from_batches([batch])
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            part = table.slice(start, stop - start)
            if begun and (start or any(part[k][0].as_py() != begun[0][k][0].as_py() for k in keys)):
                yield pa.concat_tables(begun) if len(begun) > 1 else begun[0]
                begun = []
            begun.append(part)
    if begun:
        yield pa.concat_tables(begun) if len(begun) > 1 else begun[0]


def joined_texts(key: str, place: str, kept: list[str], texts: list[str]) -> Callable:
    """Batches sorted by `key` -> a row for each key: `kept`, and the `texts` joined by commas by `place`.

    Missing texts are left out. `size` is the number of rows, `place` the last one. A key's rows are kept
    until the next key comes, and read once however many they are.
    """
    def whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(parts) if len(parts) > 1 else parts[0]
        edges = np.array([0, *(np.flatnonzero(_changes(rows[key])) + 1), rows.num_rows])
        sizes = np.diff(edges)
        order = np.lexsort((rows[place].to_numpy(), np.repeat(np.arange(len(sizes)), sizes)))
        if (np.diff(order) != 1).any():
            rows = rows.take(pa.array(order))
        joined = []
        for name in texts:
            before = np.concatenate(([0], np.cumsum(rows[name].is_valid().to_numpy(zero_copy_only=False))))
            listed = pa.ListArray.from_arrays(pa.array(before[edges], pa.int32()), rows[name].drop_null())
            joined.append(pc.binary_join(listed, ","))
        first, last = pa.array(edges[:-1]), pa.array(edges[1:] - 1)
        return pa.RecordBatch.from_arrays(
            [*(rows[name].take(first) for name in kept), *joined, pa.array(sizes, pa.int32()), rows[place].take(last)],
            names=[*kept, *texts, "size", place])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if begun and begun[0][key][0].as_py() != batch[key][0].as_py():
                yield whole(begun)
                begun = []
            cuts = np.flatnonzero(_changes(batch[key])) + 1
            if len(cuts):
                yield whole([*begun, batch.slice(0, cuts[-1])])
                begun = []
            begun.append(batch.slice(cuts[-1] if len(cuts) else 0))
        if begun:
            yield whole(begun)

    return run


def per_tree(visitor: Callable, keys: list[str], names: list[str]) -> Callable:
    """Turns a function over the rows of a tree into one over batches that are sorted by tree.

    The function may take the keys, as Arrow scalars, before the rows. Results are put together to
    batches of CHUNK trees or rows.
    """
    with_keys = len(inspect.signature(visitor).parameters) == 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.Table] = []
        rows = 0
        for tree in _runs(batches, keys):
            found = visitor(tuple(tree[k][0] for k in keys), tree) if with_keys else visitor(tree)
            done.append(found.select(names))
            rows += found.num_rows
            if rows >= CHUNK or len(done) >= CHUNK:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done, rows = [], 0
        if done:
            yield from pa.concat_tables(done).combine_chunks().to_batches()

    return run


SHAPE = "struct<valid: boolean, record_count: bigint, has_data_field: boolean, error: string>"


def _shape(payload: str | None) -> tuple:
    if payload is None:
        return None, None, None, None
    try:
        value = json.loads(payload)
    except Exception as problem:  # noqa: BLE001
        return False, None, None, f"{type(problem).__name__}: {problem}"
    if isinstance(value, dict):
        data = value.get("data")
        count = len(data) if isinstance(data, list) else len(value)
        return True, count, "data" in value, None
    return True, len(value) if isinstance(value, list) else 0, False, None


def shapes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Validity and record count of each JSON text."""
    for part in parts:
        yield pd.DataFrame(
            [_shape(p) for p in part],
            columns=["valid", "record_count", "has_data_field", "error"],
        ).astype({"valid": "boolean", "record_count": "Int64", "has_data_field": "boolean"})


def extractor(
    function: Callable[[Any, str], dict], names: list[str]
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Turns a caller's per-file function (JSON value, file name) -> record into a batch function.

    Unreadable documents give no record.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            records = []
            for file, payload in zip(frame["file"], frame["payload"], strict=True):
                try:
                    value = json.loads(payload)
                except ValueError:
                    continue
                records.append(function(value, file))
            yield pd.DataFrame(records, columns=names)

    return run
