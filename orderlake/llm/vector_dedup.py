"""Near-duplicate vectors by a robust-pruned flat graph built on overlapping cluster shards.

Vectors of one label are clustered around centres fitted on a bounded sample.
Each vector is a member of its two nearest clusters, and members are split into
chunks of bounded size, so a task holds one chunk however large a cluster or a
group of copies is.  In a chunk every vector gets a few robustly pruned
neighbours; the lists of all its chunks are united and made symmetric.

Every vector is then searched for in each cluster whose border is within the
link radius of it.  The search goes greedily from the chunk's medoid (and from
the vector itself where it is a member), then expands through all nodes within a
slightly wider range.  What is found is verified by its cosine in double
precision.  A link is counted where the found vector has its home, hence once.

Links found are audited against brute force for a bounded number of nodes: some
of all, some of those that have links.  Where too few were found, the search is
run again with more hops and a wider range, and at last with every vector held
against every node of the chunks it is asked in, which misses nothing.

Equal vectors of a label are one node with a weight, so copies are never paired.
``audited_recall`` makes the same comparison for a finished result.

Vectors that are NULL, zero or hold NULL or non-finite components, rows without
label or id, and vectors of another length than most link with nothing; they are
kept.  Repeated rows get the same result each and count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.corpus import Shelf, share_of
from orderlake.llm.vectors import matrix, usable_rows

COSINE = 0.98
#: Vectors per cluster aimed at, clusters at most, rows the centres are fitted on at most.
CLUSTER = 1024
MOST_CENTRES = 4096
CENTRE_SAMPLE = 16_384
#: Members of a chunk and vectors searched for at once, on average.
CHUNK = 2048
SEARCHED = 2048
POOL = 64
RANDOM_POOL = 16
DEGREE = 32
ALPHA = 1.2
#: Greedy hops and how far below the threshold nodes are still expanded, for one search after the other as
#: long as the audit finds too few links; None: all nodes of the chunk.
SEARCHES = ((12, 0.05), (48, 0.15), None)
#: Nodes audited among all and, again as many, among those with links; share of their links that has to be found.
AUDITED = 128
LEAST_RECALL = 0.999


def centres_of(vectors: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """A few rounds of k-means on a sample."""
    draw = np.random.default_rng(seed)
    centres = vectors[draw.permutation(len(vectors))[:count]]
    for _ in range(4 if len(centres) > 1 else 0):
        nearest = (vectors @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
        for k in range(len(centres)):
            if (nearest == k).any():
                centres[k] = vectors[nearest == k].mean(axis=0)
    return centres


def pruned(unit: np.ndarray, seed: int) -> list[np.ndarray]:
    """Robustly pruned neighbours of each row among the others of its chunk."""
    n = len(unit)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, -2.0)
    apart = np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0)).astype(np.float32)
    near = min(POOL, n - 1)
    pool = np.argpartition(apart, near - 1, axis=1)[:, :near]
    pool = np.hstack([pool, np.random.default_rng(seed).integers(0, n, (n, RANDOM_POOL))])
    rows = np.arange(n)
    left = apart[rows[:, None], pool]
    left[pool == rows[:, None]] = np.inf
    own = left.copy()
    chosen: list[list[np.ndarray]] = []
    for _ in range(min(DEGREE, n - 1)):
        at = left.argmin(axis=1)
        open_ = np.isfinite(left[rows, at])
        if not open_.any():
            break
        pick = pool[rows, at]
        chosen.append(np.where(open_, pick, -1))
        # what is nearer to the pick than to the row is reached through the pick
        covered = ALPHA * apart[pick[:, None], pool] <= own
        left[covered & open_[:, None]] = np.inf
        left[rows, at] = np.inf
        left[pool == pick[:, None]] = np.inf
    table = np.array(chosen).T.reshape(n, -1)
    return [r[r >= 0].astype(np.int64) for r in table]


class Graph:
    """Nodes of a chunk with their united neighbour lists, for many searches at once."""

    def __init__(self, unit: np.ndarray, ids: np.ndarray, neighbours: list[np.ndarray]):
        self.unit, self.ids = unit, ids
        order = np.argsort(ids)
        source = np.repeat(np.arange(len(ids)), [len(x) for x in neighbours])
        named = np.concatenate(neighbours) if neighbours else np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(ids[order], named), len(ids) - 1)
        here = ids[order][place] == named
        source, target = source[here], order[place[here]]
        both = np.unique(np.concatenate([source * len(ids) + target, target * len(ids) + source]))
        self.targets = both % len(ids)
        self.bounds = np.searchsorted(both // len(ids), np.arange(len(ids) + 1))
        self.medoid = int((unit @ unit.mean(axis=0)).argmax())

    def around(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``nodes`` and neighbours, for all neighbours of all nodes."""
        sizes = self.bounds[nodes + 1] - self.bounds[nodes]
        owner = np.repeat(np.arange(len(nodes)), sizes)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return owner, self.targets[self.bounds[nodes][owner] + offset]

    def search(self, wanted: np.ndarray, own: np.ndarray, least: float,
               reach: tuple[int, float] | None = SEARCHES[0]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``wanted``, node) with at least this cosine; ``own``: a row's own node or -1.

        ``reach``: greedy hops and the width of the range; None looks at all nodes.
        """
        if reach is None:
            return self.verified(wanted, (wanted @ self.unit.T).astype(np.float32), least)
        hops, slack = reach
        size = len(self.ids)
        cosine = np.full((len(wanted), size), -2.0, np.float32)
        done = np.zeros((len(wanted), size), bool)

        def see(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            new = cosine[rows, nodes] == -2.0
            keys = np.unique(rows[new] * size + nodes[new])
            rows, nodes = keys // size, keys % size
            for start in range(0, len(rows), 65536):
                r, k = rows[start:start + 65536], nodes[start:start + 65536]
                cosine[r, k] = np.einsum("ij,ij->i", wanted[r], self.unit[k])
            return rows, nodes

        everyone = np.arange(len(wanted))
        see(everyone, np.full(len(wanted), self.medoid))
        members = np.flatnonzero(own >= 0)
        see(members, own[members])
        for _ in range(hops):
            best = np.where(done, np.float32(-3.0), cosine)
            node = best.argmax(axis=1)
            rows = np.flatnonzero(best[everyone, node] > -2.0)
            if not len(rows):
                break
            done[rows, node[rows]] = True
            owner, neighbours = self.around(node[rows])
            see(rows[owner], neighbours)
        rows, nodes = np.nonzero((cosine >= least - slack) & ~done)
        while len(rows):
            done[rows, nodes] = True
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for start in range(0, len(rows), 4096):
                r, k = rows[start:start + 4096], nodes[start:start + 4096]
                owner, neighbours = self.around(k)
                found.append(see(r[owner], neighbours))
            rows, nodes = (np.concatenate(x) for x in zip(*found))
            wide = (cosine[rows, nodes] >= least - slack) & ~done[rows, nodes]
            rows, nodes = rows[wide], nodes[wide]
        return self.verified(wanted, cosine, least)

    def verified(self, wanted: np.ndarray, cosine: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose cosine in double precision is large enough, of those that single precision leaves possible."""
        rows, nodes = np.nonzero(cosine >= least - 1e-5)
        exact = np.concatenate([np.einsum("ij,ij->i", wanted[rows[s:s + 65536]], self.unit[nodes[s:s + 65536]])
                                for s in range(0, len(rows), 65536)] or [np.zeros(0)])
        return rows[exact >= least], nodes[exact >= least]


def smallest_reached(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` places the smallest place it is linked to, directly or not."""
    low = np.arange(size)
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            return low


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    spark = embeddings.sparkSession
    shelf = Shelf(spark, "vectors")
    rows = usable_rows(embeddings.where(F.col(label).isNotNull()), key, vector, label).select(
        F.col(key).alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"),
        F.xxhash64(vector).alias("h1"), F.xxhash64(vector, F.lit(1)).alias("h2"))
    rows = shelf.keep(rows, "rows")
    same = ["label", "h1", "h2"]
    classes = shelf.keep(rows.groupBy(*same).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")),
                         "classes")
    nodes = shelf.keep(rows.join(classes, same).where("id = node").select("node", "label", "v", "weight"), "nodes")
    links = _node_links(shelf, nodes, cosine) if not nodes.isEmpty() else None
    if links is None:
        found = classes.select(*same, F.lit(0).cast("bigint").alias("n_links"), F.col("node").alias("component"))
    else:
        counted = links.groupBy(F.col("id").alias("node")).agg(F.sum("n_links").alias("n_links"))
        tree = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")), shelf, "vectors")
        found = (classes.join(counted, "node", "left")
                 .join(tree.select("node", "component"), "node", "left")
                 .select(*same, (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "node").alias("component")))
    found = shelf.keep(found, "found")
    known = rows.select("id", *same).join(found, same).select(F.col("id").alias(key), "n_links", "component")
    return (embeddings.select(key).join(known, key, "left")
            .select(key, F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    F.coalesce("component", F.col(key)).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))


def node_recall(nodes: DataFrame, links: DataFrame, dim: int, least: float) -> float:
    """Share of the links of at most ``2 * AUDITED`` nodes that was found, by weight.

    The nodes are chosen by the hash of their ids.  Every task holds its own
    vectors against theirs, so the truth costs one scan and the driver gets one
    count per audited node.
    """
    counted = links.groupBy("id").agg(F.sum("n_links").alias("n"))
    linked = counted.where("n > 0").orderBy(F.xxhash64("id"), "id").limit(AUDITED).select("id")
    drawn = nodes.select(F.col("node").alias("id")).orderBy(F.xxhash64("id"), "id").limit(AUDITED)
    ids = [r.id for r in linked.union(drawn).distinct().orderBy("id").collect()]
    asked = nodes.where(F.col("node").isin(ids)).select("node", "label", "v").orderBy("node").toArrow()
    wanted = matrix(asked.column("v"), dim)
    wanted = wanted / np.linalg.norm(wanted, axis=1, keepdims=True)
    names, own = np.array(asked.column("label").to_pylist(), object), asked.column("node").to_numpy()

    def linked_weight(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(own), np.int64)
        for batch in batches:
            unit = matrix(batch.column(2), dim)
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            # a pair on the very threshold may fall either way with the order of the sum
            near = unit @ wanted.T >= least + 1e-12
            near &= np.array(batch.column(1).to_pylist(), object)[:, None] == names
            near &= batch.column(0).to_numpy()[:, None] != own
            total += batch.column(3).to_numpy() @ near
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total)], ["id", "n"])

    rows = nodes.select("node", "label", "v", "weight").mapInArrow(linked_weight, "id bigint, n bigint")
    true = {r.id: r.n for r in rows.groupBy("id").agg(F.sum("n").alias("n")).where("n > 0").collect()}
    found = {r.id: r.n for r in counted.where(F.col("id").isin(ids)).collect()}
    every = sum(true.values())
    return sum(min(n, found.get(k, 0)) for k, n in true.items()) / every if every else 1.0


def _node_links(shelf: Shelf, nodes: DataFrame, least: float) -> DataFrame:
    """``id, n_links, root``: verified links of nodes by weight, and a smaller node each is connected with."""
    radius = math.sqrt(2 - 2 * least)
    sizes = {r.label: r.n for r in nodes.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "label").limit(MOST_CENTRES).collect()}
    total, dim = nodes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    sample = nodes.where(share_of("node", min(1.0, CENTRE_SAMPLE / total))).orderBy("node").select("label", "v").toArrow()
    drawn = matrix(sample.column("v"), dim) if sample.num_rows else np.zeros((0, dim))
    drawn = drawn / np.linalg.norm(drawn, axis=1, keepdims=True)
    named = np.array(sample.column("label").to_pylist(), object)
    centres: dict[str, np.ndarray] = {}
    first: dict[str, int] = {}
    for name, n in sizes.items():
        most = max(1, min(math.ceil(n / CLUSTER), MOST_CENTRES * n // total))
        of_label = drawn[named == name]
        centres[name] = centres_of(of_label, most) if len(of_label) else np.zeros((1, dim))
        first[name] = sum(map(len, centres.values())) - len(centres[name])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            unit = matrix(batch.column(2), dim)
            unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
            for i, (node, name, weight) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)))):
                own = centres.get(name)
                base = first.get(name, -1)
                # labels beyond the listed ones are small: each is one cluster without number
                near = np.zeros(1) if own is None else ((unit[i] - own) ** 2).sum(axis=1)
                home = int(near.argmin())
                member = set(np.argsort(near, kind="stable")[:2].tolist())
                wide = (np.zeros(1) if own is None else
                        2 * radius * np.sqrt(((own - own[home]) ** 2).sum(axis=1)))
                for k in range(len(near)):
                    asked = bool(near[k] - near[home] <= wide[k] + 1e-9)
                    if k in member or asked:
                        out.append((node, name, base + k if base >= 0 else -1, k == home, k in member, asked,
                                    unit[i].tobytes(), weight))
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, KIND)], KIND.names)

    spread = shelf.keep(nodes.select("node", "label", "v", "weight").mapInArrow(placed, PLACED), "placed")
    member, asked = spread.where("member"), spread.where("asked")
    where = ["label", "cluster"]
    chunks = shelf.keep(
        spread.groupBy(*where).agg(F.ceil(F.sum(F.col("member").cast("int")) / CHUNK).cast("int").alias("chunks"),
                                   F.ceil(F.sum(F.col("asked").cast("int")) / SEARCHED).cast("int").alias("blocks"))
        .where("chunks > 0"), "chunks")
    member = member.join(chunks, where).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))

    def build(part: pa.Table) -> pa.Table:
        unit = np.array([np.frombuffer(x, "<f8") for x in part.column("unit").to_pylist()])
        ids = part.column("node").to_numpy()
        lists = pruned(unit, len(ids))
        return pa.table({"node": part.column("node"), "near": pa.array([ids[x] for x in lists], pa.list_(pa.int64()))})

    near = member.groupBy(*where, "chunk").applyInArrow(build, "node bigint, near array<bigint>")
    united = shelf.keep(near.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")),
                        "united")
    graph = (member.join(united, "node")
             .select(*where, "chunk", "node", "unit", "weight", "home", "near",
                     F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks") - 1, F.lit(0)))).alias("block")))
    queries = (asked.join(chunks, where)
               .select(F.col("label").alias("q_label"), F.col("cluster").alias("q_cluster"),
                       F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("q_chunk"),
                       F.pmod(F.xxhash64("node", F.lit(1)), F.greatest("blocks", F.lit(1))).cast("int").alias("q_block"),
                       F.col("node").alias("q_node"), F.col("unit").alias("q_unit")))

    def search(part: pa.Table, asked: pa.Table, reach: tuple[int, float] | None) -> pa.Table:
        out = {"id": np.zeros(0, np.int64), "n_links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)}
        if part.num_rows and asked.num_rows:
            unit = np.array([np.frombuffer(x, "<f8") for x in part.column("unit").to_pylist()])
            ids, wanted_ids = part.column("node").to_numpy(), asked.column("q_node").to_numpy()
            weight, home = part.column("weight").to_numpy(), part.column("home").to_numpy(zero_copy_only=False)
            graph = Graph(unit, ids, [np.array(x, np.int64) for x in part.column("near").to_pylist()])
            wanted = np.array([np.frombuffer(x, "<f8") for x in asked.column("q_unit").to_pylist()])
            order = np.argsort(ids)
            place = np.minimum(np.searchsorted(ids[order], wanted_ids), len(ids) - 1)
            own = np.where(ids[order][place] == wanted_ids, order[place], -1)
            rows, found = graph.search(wanted, own, least, reach)
            good = home[found] & (ids[found] != wanted_ids[rows])
            rows, found = rows[good], found[good]
            links = np.bincount(rows, weight[found], len(wanted)).astype(np.int64)
            # a spanning forest of what was found stands for all links
            every = np.unique(np.concatenate([wanted_ids[rows], ids[found]]))
            low = smallest_reached(len(every), np.searchsorted(every, wanted_ids[rows]),
                                   np.searchsorted(every, ids[found]))
            asked_links = np.zeros(len(every), np.int64)
            linked = np.flatnonzero(links)
            asked_links[np.searchsorted(every, wanted_ids[linked])] = links[linked]
            out = {"id": every, "n_links": asked_links, "root": every[low]}
        return pa.table(out)

    def links_within(reach: tuple[int, float] | None) -> DataFrame:
        found = (graph.groupBy(*where, "chunk", "block")
                 .cogroup(queries.groupBy("q_label", "q_cluster", "q_chunk", "q_block"))
                 .applyInArrow(lambda part, asked: search(part, asked, reach), "id bigint, n_links bigint, root bigint"))
        return shelf.keep(found, "links")

    for reach in SEARCHES:
        links = links_within(reach)
        if reach is None or node_recall(nodes, links, dim, least) >= LEAST_RECALL:
            break
    return links


PLACED = ("node bigint, label string, cluster int, home boolean, member boolean, asked boolean, "
          "unit binary, weight bigint")
KIND = pa.schema([("node", pa.int64()), ("label", pa.string()), ("cluster", pa.int32()), ("home", pa.bool_()),
                  ("member", pa.bool_()), ("asked", pa.bool_()), ("unit", pa.binary()), ("weight", pa.int64())])


def audited_recall(embeddings: DataFrame, found: DataFrame, queries: int = 64, cosine: float = COSINE) -> float:
    """Links that ``found`` counts for a bounded number of vectors, as a share of those brute force finds."""
    rows = usable_rows(embeddings.where("label IS NOT NULL"), "vec_id", "embedding", "label")
    asked = (rows.select(F.col("vec_id").alias("q"), F.col("embedding").alias("w"), F.col("label"))
             .orderBy(F.xxhash64("q")).limit(queries))

    def total(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    cos = total("embedding", "w") / F.sqrt(total("embedding", "embedding") * total("w", "w"))
    true = (rows.join(F.broadcast(asked), "label").where((F.col("vec_id") != F.col("q")) & (cos >= cosine))
            .groupBy(F.col("q").alias("vec_id")).agg(F.count(F.lit(1)).alias("n")))
    both = true.join(found.select("vec_id", "n_links").dropDuplicates(), "vec_id")
    hits, all_links = both.agg(F.sum(F.least("n", "n_links")), F.sum("n")).first()
    return 1.0 if not all_links else hits / all_links
