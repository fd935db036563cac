"""Near-duplicate vectors by navigable small-world graphs, one per shard of a label."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querytrail.llm.graph import components
from querytrail.session import ship, store


#: Vectors whose id this divides are searched for by comparison too, and at least so many of a block.
AUDIT, LEAST_AUDIT = 50, 64


class Graph:
    """Hierarchical navigable small-world graph over unit vectors; similarity is their dot product."""

    def __init__(self, vectors: np.ndarray, degree: int = 12, beam: int = 48, seed: int = 7):
        self.vectors, self.degree, self.beam = vectors, degree, beam
        n = len(vectors)
        draws = np.random.default_rng(seed).random(n)
        self.levels = np.minimum((-np.log(1 - draws) / np.log(degree)).astype(np.int64), 12)
        top = int(self.levels.max()) if n else 0
        # Layer 0 holds twice the neighbours; -1 marks a free place.
        self.near = [np.full((n, degree * (2 if layer == 0 else 1)), -1, np.int32)
                     for layer in range(top + 1)]
        self.filled = [np.zeros(n, np.int32) for _ in range(top + 1)]
        self.entry, self.height = 0, int(self.levels[0]) if n else 0
        self.seen, self.stamp = np.zeros(n, np.int32), 0
        self.chosen = np.full((n, degree), -1, np.int32)
        for node in range(1, n):
            self._insert(node)
        self._join_edges()

    def _join_edges(self) -> None:
        """All edges of layer 0, in both directions: those kept and those first chosen. In a dense cluster
        vectors crowd each other out of their lists, but each has chosen some of it when it came."""
        n = len(self.vectors)
        ends = [np.zeros((0, 2), np.int64)]
        for held in (self.near[0], self.chosen):
            rows, places = np.nonzero(held >= 0)
            ends.append(np.stack([rows, held[rows, places].astype(np.int64)], axis=1))
        one = np.concatenate(ends)
        codes = np.unique(np.concatenate([one[:, 0] * n + one[:, 1], one[:, 1] * n + one[:, 0]])) if n else one[:, 0]
        self.edge_ends = (codes % max(n, 1)).astype(np.int32)
        self.edge_starts = np.searchsorted(codes, np.arange(n + 1, dtype=np.int64) * n)

    def _neighbours(self, layer: int, node: int) -> np.ndarray:
        return self.near[layer][node, :self.filled[layer][node]]

    def _descend(self, query: np.ndarray, start: int, high: int, low: int) -> int:
        """Closest node found by greedy steps in the layers from `high` down to above `low`."""
        best, similarity = start, float(self.vectors[start] @ query)
        for layer in range(high, low, -1):
            while True:
                around = self._neighbours(layer, best)
                if not len(around):
                    break
                found = self.vectors[around] @ query
                at = int(found.argmax())
                if found[at] <= similarity:
                    break
                best, similarity = int(around[at]), float(found[at])
        return best

    def _search(
        self, query: np.ndarray, starts: list[int], beam: int, layer: int
    ) -> list[tuple[float, int]]:
        """The `beam` most similar nodes found."""
        self.stamp += 1
        seen, stamp, vectors = self.seen, self.stamp, self.vectors
        seen[starts] = stamp
        first = [(float(vectors[s] @ query), s) for s in starts]
        open_ = [(-s, node) for s, node in first]
        best = list(first)
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            similarity, node = heapq.heappop(open_)
            if -similarity < best[0][0] and len(best) >= beam:
                break
            around = self._neighbours(layer, node)
            around = around[seen[around] != stamp]
            if not len(around):
                continue
            seen[around] = stamp
            found = vectors[around] @ query
            for s, other in zip(found.tolist(), around.tolist(), strict=True):
                if len(best) < beam or s > best[0][0]:
                    heapq.heappush(open_, (-s, other))
                    heapq.heappush(best, (s, other))
                    if len(best) > beam:
                        heapq.heappop(best)
        return best

    def _pick(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Close nodes that are not closer to one picked before; then the closest of the others."""
        found = sorted(found, reverse=True)
        ids = [node for _, node in found]
        among = self.vectors[ids] @ self.vectors[ids].T
        picked: list[int] = []
        for i, (similarity, _) in enumerate(found):
            if len(picked) == most:
                break
            if not picked or among[i, picked].max() < similarity:
                picked.append(i)
        rest = [i for i in range(len(found)) if i not in set(picked)]
        return [ids[i] for i in (picked + rest)[:most]]

    def _insert(self, node: int) -> None:
        query, level = self.vectors[node], int(self.levels[node])
        start = self._descend(query, self.entry, self.height, level)
        starts = [start]
        for layer in range(min(level, self.height), -1, -1):
            found = self._search(query, starts, self.beam, layer)
            picked = self._pick(found, self.degree)
            self.near[layer][node, :len(picked)] = picked
            self.filled[layer][node] = len(picked)
            if layer == 0:
                self.chosen[node, :len(picked)] = picked
            for other in picked:
                self._add(layer, other, node)
            starts = [n for _, n in found]
        if level > self.height:
            self.entry, self.height = node, level

    def _add(self, layer: int, node: int, new: int) -> None:
        n, room = int(self.filled[layer][node]), self.near[layer].shape[1]
        if n < room:
            self.near[layer][node, n] = new
            self.filled[layer][node] = n + 1
            return
        around = [*self.near[layer][node].tolist(), new]
        similar = (self.vectors[around] @ self.vectors[node]).tolist()
        picked = self._pick(list(zip(similar, around, strict=True)), room)
        self.near[layer][node, :len(picked)] = picked

    def links(self, query: np.ndarray, beam: int, least: float) -> np.ndarray:
        """Nodes with similarity `least` or more: those that a beam of this width meets, and from them on
        all that edges between such nodes reach, a wave at a time."""
        start = self._descend(query, self.entry, self.height, 0)
        wave = np.array([n for s, n in self._search(query, [start], beam, 0) if s >= least], np.int64)
        held = np.zeros(len(self.vectors), bool)
        seen = held.copy()
        seen[wave] = True
        while len(wave):
            held[wave] = True
            starts, counts = self.edge_starts[wave], self.edge_starts[wave + 1] - self.edge_starts[wave]
            at = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
            around = np.zeros(len(held), bool)
            around[self.edge_ends[at]] = True
            fresh = np.flatnonzero(around & ~seen)
            seen[fresh] = True
            wave = fresh[self.vectors[fresh] @ query >= least]
        return np.flatnonzero(held)


def _unit(rows: list) -> np.ndarray:
    vectors = np.array(rows, dtype=np.float64)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def audited_links(
    graph: Graph, queries: np.ndarray, least: float, recall: float = 0.99, ids: np.ndarray | None = None,
) -> tuple[list[np.ndarray], float, int]:
    """Links of every query, the recall measured, and the beam that passed.

    Queries whose id is divisible by AUDIT, and LEAST_AUDIT spread over all, are compared with all
    vectors of the shard. The beam is doubled until they have `recall` of the true links; at the size of
    the shard the search is replaced by the comparison itself.
    """
    n = len(graph.vectors)
    if not n or not len(queries):
        return [np.zeros(0, np.int64)] * len(queries), 1.0, 0
    spread = np.linspace(0, len(queries) - 1, min(LEAST_AUDIT, len(queries))).astype(np.int64)
    sample = np.union1d(spread, np.flatnonzero((np.arange(len(queries)) if ids is None else ids) % AUDIT == 0))
    true = np.concatenate([
        queries[sample[at:at + 256]] @ graph.vectors.T >= least for at in range(0, len(sample), 256)])
    total, beam = int(true.sum()), graph.beam
    while beam < n:
        found = sum(int(true[i, graph.links(queries[q], beam, least)].sum()) for i, q in enumerate(sample))
        if found >= recall * total:
            return [graph.links(q, beam, least) for q in queries], found / total if total else 1.0, beam
        beam *= 2
    every = []
    for at in range(0, len(queries), 256):
        hits = queries[at:at + 256] @ graph.vectors.T >= least
        every += [np.flatnonzero(row) for row in hits]
    return every, 1.0, n


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


_FOUND = pa.schema([("rep", pa.int64()), ("n_links", pa.int64()), ("root", pa.int64()),
                    ("recall", pa.float64()), ("beam", pa.int64())])


def _found(reps: np.ndarray, weights: np.ndarray, roots: np.ndarray, recall: float, beam: int) -> pa.RecordBatch:
    """One row per vector of the task: links counted here and the smallest row it is connected to here."""
    return pa.RecordBatch.from_arrays(
        [pa.array(reps), pa.array(weights), pa.array(roots), pa.array([recall] * len(reps), pa.float64()),
         pa.array([beam] * len(reps), pa.int64())], schema=_FOUND)


def _counted(links: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a shard the number of others it is linked with, found from either end, and the
    first vector that links lead to. A bit per pair: 8 MB for a shard of 8192, however dense it is."""
    n = len(links)
    bits = np.zeros((n, (n + 7) // 8), np.uint8)
    for at in range(0, n, 512):
        rows = np.zeros((min(512, n - at), n), bool)
        for i, found in enumerate(links[at:at + 512]):
            rows[i, found] = True
            rows[i, at + i] = True
        bits[at:at + len(rows)] |= np.packbits(rows, axis=1)
        # The same links from the other end.
        ends, starts = np.nonzero(rows.T)
        np.bitwise_or.at(bits, (ends, (at + starts) // 8), (128 >> (at + starts) % 8).astype(np.uint8))
    weights, roots = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for at in range(0, n, 512):
        rows = np.unpackbits(bits[at:at + 512], axis=1, count=n)
        weights[at:at + 512] = rows.astype(np.float64) @ sizes - 1
    for first in range(n):
        wave = np.array([first]) if roots[first] < 0 else np.zeros(0, np.int64)
        while len(wave):
            roots[wave] = first
            reached = np.zeros(bits.shape[1], np.uint8)
            for at in range(0, len(wave), 512):
                reached |= np.bitwise_or.reduce(bits[wave[at:at + 512]], axis=0)
            wave = np.flatnonzero(np.unpackbits(reached, count=n).astype(bool) & (roots < 0))
    return weights, roots


def _classes(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, embedding) of the vectors that can be linked."""
    usable = (
        F.col("label").isNotNull() & F.col("id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    return vectors.select(
        F.col(id_column).cast("long").alias("id"),
        # Vectors of unequal length are not compared.
        F.when(F.col(label_column).isNotNull(), F.concat_ws(
            ":", F.size(vector_column).cast("string"), F.col(label_column).cast("string"))).alias("label"),
        F.col(vector_column).cast("array<double>").alias("embedding")).filter(usable)


def link_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label", least: float = 0.93, shard_rows: int = 8192, block_rows: int = 2048,
    degree: int = 12, beam: int = 48, recall: float = 0.99,
) -> DataFrame:
    """(rep, n_links, root, recall, beam): what each search task found about its vectors.

    Equal vectors of a label are one class, named after its smallest id, so copies are searched once.
    The classes of a label are dealt over shards of about `shard_rows` by hash, a graph is built per
    shard, and its own vectors are searched in it in the building task. If a label has several
    shards, blocks of `block_rows` vectors of each later shard are searched in every earlier shard's
    graph, so every pair of shards meets once. Tasks give one row per vector, never pairs.
    Memory: one shard and one block.
    """
    ship(vectors.sparkSession)
    usable = _classes(vectors, id_column, vector_column, label_column)
    classes = store(
        usable.groupBy("label", "embedding").agg(
            F.min("id").alias("rep"), F.count_distinct("id").alias("size")), "vector-classes")
    shards = store(
        classes.groupBy(F.col("label").alias("of")).agg(
            F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("shards")), "shards")
    dealt = store(
        classes.join(shards, F.col("label") == F.col("of")).withColumn(
            "shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))
        .select("label", "shard", "shards", "rep", "size", "embedding"), "dealt-vectors")

    def build(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("rep").to_numpy())
        table = table.take(pa.array(order))
        reps, sizes = table.column("rep").to_numpy(), table.column("size").to_numpy()
        graph = Graph(_unit(table.column("embedding").to_pylist()), degree, beam)
        links, measured, width = audited_links(graph, graph.vectors, least, recall, reps)
        weights, roots = _counted(links, sizes)
        held = pickle.dumps((graph, reps, sizes)) if table.column("shards")[0].as_py() > 1 else b""
        own = _found(reps, weights, reps[roots], measured, width)
        return pa.table({
            "label": [table.column("label")[0].as_py()], "shard": [table.column("shard")[0].as_py()],
            "graph": [held], "own": [own.to_pylist()]}, schema=shard_schema)

    label_type = dealt.schema["label"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    shard_schema = pa.schema([
        ("label", to_arrow_type(dealt.schema["label"].dataType)), ("shard", pa.int32()),
        ("graph", pa.binary()), ("own", pa.list_(pa.struct(list(_FOUND))))])
    found_type = "rep long, n_links long, root long, recall double, beam long"
    built = store(dealt.groupBy("label", "shard").applyInArrow(
        build, f"label {label_type}, shard int, graph binary, own array<struct<"
        + found_type.replace(" ", ":").replace(",:", ",") + ">>"), "graphs")
    own = built.select(F.inline("own"))

    block = F.floor(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 20)) * F.ceil(
        F.lit(shard_rows / block_rows)) / F.lit(1 << 20)).cast("int")
    blocks = (
        dealt.filter("shards > 1").groupBy("label", "shard", block.alias("block"))
        .agg(F.collect_list(F.struct("rep", "size", "embedding")).alias("rows"))
    )
    graphs = built.filter(F.length("graph") > 0).select(
        F.col("label").alias("in_label"), F.col("shard").alias("in_shard"), "graph")
    met = blocks.join(graphs, (F.col("label") == F.col("in_label")) & (F.col("in_shard") < F.col("shard")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, rows in zip(batch.column(0), batch.column(1), strict=True):
                graph, reps, sizes = pickle.loads(held.as_py())
                rows = rows.as_py()
                ids = np.array([r["rep"] for r in rows], np.int64)
                counts = np.array([r["size"] for r in rows], np.int64)
                links, measured, width = audited_links(
                    graph, _unit([r["embedding"] for r in rows]), least, recall, ids)
                n = len(reps)
                union, weights = _Union(n + len(ids)), np.zeros(n + len(ids), np.int64)
                for i, found in enumerate(links):
                    weights[n + i] += sizes[found].sum()
                    weights[found] += counts[i]
                    for j in found.tolist():
                        union.join(n + i, j)
                both = np.concatenate([reps, ids])
                yield _found(both, weights, both[[union.root(i) for i in range(len(both))]], measured, width)

    across = met.select("graph", "rows").mapInArrow(search, found_type)
    return own.union(across)


def near_duplicate_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    label_column: str = "label", least: float = 0.93, **options,
) -> DataFrame:
    """(id, n_links, component_id, kept, recall) of every vector.

    `n_links` counts the other vectors of its label with cosine `least` or more, `component_id` is the
    smallest id reachable by such links, `kept` whether that is its own. Vectors that are null, zero
    or hold null or non-finite components, and rows without a label or an id, link with nothing and
    are kept (without an id: null component, kept). Rows that repeat an id, label and vector are one vector.
    Vectors of unequal length are not linked. `recall` is the lowest share of true links that the audits of
    a vector's searches have found; 1 where nothing was to be searched.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("embedding")).distinct()
    usable = store(
        _classes(vectors, id_column, vector_column, label_column).distinct(), "usable-vectors")
    found = store(link_vectors(
        vectors, id_column, vector_column, label_column, least, **options), "found-links")
    counted = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"), F.min("recall").alias("recall"))
    group = components(found.filter("root <> rep").select(
        F.col("root").alias("a"), F.col("rep").alias("b")).distinct())
    reps = store(
        counted.join(group, F.col("rep") == F.col("node"), "left")
        .select("rep", "n_links", "recall", F.coalesce("component", "rep").alias("component_id")), "vector-reps")
    smallest = usable.groupBy("label", "embedding").agg(F.min("id").alias("rep"))
    members = store(
        usable.join(store(smallest, "class-names"), ["label", "embedding"]).select("id", "rep"), "members")
    # The smallest id of a component is the smallest id of one of its classes.
    linked = members.join(reps, "rep").groupBy(F.col("id").alias("of")).agg(
        F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"),
        F.min("recall").alias("recall"))
    return (
        rows.select("id").distinct().join(linked, F.col("id") == F.col("of"), "left")
        .select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("component_id", "id").alias("component_id"),
                F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
                F.coalesce("recall", F.lit(1.0)).alias("recall"))
    )
