"""Operator 6, embedding near-dedup: a robust-pruned flat graph over overlapping cluster shards.

Equal vectors meet in one representative. Cluster centres grow with the vectors: up to MAX_CENTRES come from a bounded sample;
where that leaves cells of more than CELL vectors, each cell has centres of its own, from a bounded sample of the cell. Of
centres within the threshold's angle of each other one is kept, so a group of near copies has one shard however many
centres fell into it. Every representative joins the shards of its `overlap` nearest centres; that of the nearest is its home.
Shards are dealt into blocks, so no task holds more than about 2*BLOCK vectors. Each block builds a graph: near and random candidates,
pruned so that no neighbour hides behind a closer one, with edges both ways. A vector's neighbour lists, with the
neighbours' homes, are united over all its shards.

Queries walk greedily from the block's medoid, their own nodes and the nodes that led them there, many at a time, and expand all that is in
range. They begin at home. A walk that finds a node in range whose home is elsewhere goes on in that shard, as does one whose
united lists lead elsewhere from a node within twice the threshold's angle, unless that edge's own angle rules the neighbour out:
round by round, until no query has a shard left to visit. Links are verified by cosine in double
precision and counted where the found vector is at home, so once; each block passes on a star for each group of linked
vectors, never its pairs.

Rounds of AUDIT queries are compared with all vectors by brute force until LINKED of them have links (AUDIT_ROUNDS at
most); if too few have, vectors that the search found links for are audited too. Recall is the lesser of the share of
their links found and the mean of each query's share; if it is below `least_recall` the search is repeated with more
overlap, a wider beam and centres further apart. Recall is returned.

Vectors that are null, zero, empty or hold null or non-finite components link with nothing; vectors of different
lengths don't link. Floats and doubles are compared as they are, whatever their size. Null vec_ids count as vectors; a component's id is the smallest id in it. Rows that repeat link
with each other. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import connected_components, materialize, union_all

SAMPLE, TARGET, MAX_CENTRES, BLOCK, OVERLAP = 20_000, 2_000, 1_024, 4_096, 3
CELL = 20_000  # vectors that the cell of a centre may hold before it has centres of its own
DEGREE, NEAR, FAR, ALPHA, BEAM, STEP = 16, 32, 8, 1.2, 24, 4
_QUERIES = 512
_PAIRS = 1 << 17
AUDIT, AUDIT_ROUNDS, LINKED = 512, 8, 64
MAX_VISITS = 100


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near one: no square overflows or vanishes, no cosine changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(column) -> np.ndarray:
    """One row of doubles a vector; all have one length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _dots(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
    """x[i] . y[j] for each pair of rows, some pairs at a time."""
    out = np.empty(len(i), x.dtype)
    for k in range(0, len(i), _PAIRS):
        part = slice(k, k + _PAIRS)
        out[part] = np.einsum("nd,nd->n", x[i[part]], y[j[part]])
    return out


def _apart(c: np.ndarray, size: np.ndarray, angle: float) -> np.ndarray:
    """The centres, largest first, without those within the angle of one before."""
    c = c[np.argsort(-size, kind="stable")]
    near = c @ c.T >= np.cos(angle)
    kept = np.zeros(len(c), bool)
    for k in range(len(c)):
        kept[k] = not (near[k] & kept).any()
    return c[kept]


def _k_means(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit vectors: centres and their sizes."""
    c = x[np.random.default_rng(7).choice(len(x), k, replace=False)]
    for _ in range(6 if k > 1 else 0):
        home = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), c)
    return c, np.bincount((x @ c.T).argmax(1), minlength=k)


def _centres(sample: pa.Table, total: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Centres of each vector length's sample, with their sizes in it."""
    out = {}
    for dim in pa.compute.unique(sample.column("dim")).to_pylist():
        if dim in total:
            x = _unit(_vectors(sample.filter(pa.compute.equal(sample.column("dim"), dim)).column("embedding")))
            out[int(dim)] = _k_means(x, min(MAX_CENTRES, len(x), max(1, -(-total[dim] // TARGET))))
    return out


def _nearest(v: np.ndarray, c: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centre, and those of the overlap (the nearest among them)."""
    s = v @ c.T
    n = min(overlap, s.shape[1])
    return s.argmax(1), np.argpartition(-s, n - 1, axis=1)[:, :n]


def _cells(centres, overlap: int):
    """Vectors with the cells of their nearest centres: one row each, `home` for the nearest."""

    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = b.take(pa.array(np.flatnonzero(dims == dim)))
                m = part.num_rows
                if dim in centres.value:
                    best, near = _nearest(_unit(_vectors(part.column("embedding"))), centres.value[dim], overlap)
                else:  # a length of few vectors: one cell
                    best, near = np.zeros(m, np.int64), np.zeros((m, 1), np.int64)
                who, which = np.repeat(np.arange(m), near.shape[1]), near.ravel()
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(who)) for c in ("id", "n", "dim", "embedding")), pa.array(which, pa.int32()), pa.array(which == best[who])], ["id", "n", "dim", "embedding", "cell", "home"])

    return run


def _inner_centres(size: int, angle: float):
    """The centres of one large cell, from a sample of its vectors."""

    def run(table: pa.Table) -> pa.Table:
        x = _unit(_vectors(table.column("embedding")))
        total = table.column("total")[0].as_py()
        c = _apart(*_k_means(x, min(MAX_CENTRES, len(x), max(1, -(-total // TARGET)))), angle)
        return pa.table({"dim": pa.array([table.column("dim")[0].as_py()], pa.int32()), "cell": pa.array([table.column("cell")[0].as_py()], pa.int32()), "centres": pa.array([c.ravel().tolist()], pa.list_(pa.float64()))})

    return run


def _inner_shards(overlap: int):
    """Vectors of a part of one large cell, with the shards of the cell's own centres."""

    def run(vectors: pa.Table, centres: pa.Table) -> pa.Table:
        if not vectors.num_rows:
            best = near = np.zeros((0, 1), np.int64)
        else:
            c = np.array(centres.column("centres")[0].as_py()).reshape(-1, vectors.column("dim")[0].as_py())
            best, near = _nearest(_unit(_vectors(vectors.column("embedding"))), c, overlap)
        who, which = np.repeat(np.arange(vectors.num_rows), near.shape[1]), near.ravel()
        out = vectors.select(["id", "n", "dim", "embedding", "cell", "home"]).take(pa.array(who, pa.int64()))
        home = out.column("home").to_numpy() & (which == best.ravel()[who]) if len(who) else np.zeros(0, bool)
        return out.set_column(5, "home", pa.array(home)).append_column("sub", pa.array(which, pa.int32()))

    return run


def build_graph(x: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Robust-pruned graph of unit vectors: edges both ways, as (first end, second end) in order of the first."""
    n = len(x)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rng = np.random.default_rng(seed)
    x = x.astype(np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    near = min(NEAR, n - 1)
    me = np.arange(n)
    cand = np.concatenate([*[np.argpartition(-sims[i : i + 256], near - 1, axis=1)[:, :near] for i in range(0, n, 256)]])
    cand = np.concatenate([cand, rng.integers(0, n, (n, FAR))], axis=1)
    dist = 1 - sims[me[:, None], cand]
    alive = cand != me[:, None]
    keys = []
    for _ in range(DEGREE):
        k = np.where(alive, dist, np.inf).argmin(1)
        star = cand[me, k]
        keys.append((me * n + star)[alive[me, k]])
        hidden = ALPHA * (1 - sims[star[:, None], cand]) <= dist
        alive &= ~hidden & (cand != star[:, None])
    key = np.concatenate(keys)
    key = np.unique(np.concatenate([key, key % n * n + key // n]))
    return key // n, key % n


class _Block:
    """Vectors of a block and the graph among them."""

    def __init__(self, x: np.ndarray, a: np.ndarray, b: np.ndarray):
        self.x, self.to = x.astype(np.float32), b
        self.start = np.searchsorted(a, np.arange(len(x) + 1))
        self.medoid = int((x @ x.mean(0)).argmax())

    def _expand(self, rows: np.ndarray, nodes: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unseen neighbours of (row, node) pairs, each pair once and in order; they count as seen from here on."""
        degree = self.start[nodes + 1] - self.start[nodes]
        ends = np.cumsum(degree)
        at = np.repeat(self.start[nodes] - ends + degree, degree) + np.arange(ends[-1] if len(ends) else 0)
        key = np.repeat(rows, degree) * seen.shape[1] + self.to[at]
        key = np.unique(key[~seen.ravel()[key]])
        seen.ravel()[key] = True
        return key // seen.shape[1], key % seen.shape[1]

    def search(self, q: np.ndarray, rows: np.ndarray, nodes: np.ndarray, threshold: float, wide: float, beam: int) -> tuple[np.ndarray, ...]:
        """(query, node) pairs in range that the walks find, and those between `wide` and the threshold; (rows, nodes): where queries begin besides the medoid."""
        q = q.astype(np.float32)
        n, m = len(self.x), len(q)
        every = np.arange(m)
        seen = np.zeros((m, n), bool)
        ids, sims, done = np.zeros((m, beam), np.int64), np.full((m, beam), -np.inf, np.float32), np.ones((m, beam), bool)
        key = np.unique(np.concatenate([every * n + self.medoid, rows * n + nodes]))
        rows, nodes = key // n, key % n
        seen.ravel()[key] = True
        edge = []
        hits = []
        while True:
            s = _dots(self.x, nodes, q, rows)
            inside, close = s >= threshold, (s >= wide) & (s < threshold)
            hits.append((rows[inside], nodes[inside]))
            edge.append((rows[close], nodes[close]))
            count = np.bincount(rows, minlength=m)
            width = int(count.max(initial=0))
            if width:
                place = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
                more_ids, more_sims, more_done = np.zeros((m, width), np.int64), np.full((m, width), -np.inf, np.float32), np.ones((m, width), bool)
                more_ids[rows, place], more_sims[rows, place], more_done[rows, place] = nodes, s, False
                ids, sims, done = (np.concatenate(p, axis=1) for p in ((ids, more_ids), (sims, more_sims), (done, more_done)))
                top = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
                ids, sims, done = (np.take_along_axis(p, top, 1) for p in (ids, sims, done))
            open_ = np.where(done, -np.inf, sims)
            step = np.argpartition(-open_, STEP - 1, axis=1)[:, :STEP]
            ok = np.take_along_axis(open_, step, 1) > -np.inf
            if not ok.any():
                break
            np.put_along_axis(done, step, True, 1)
            rows, nodes = self._expand(np.repeat(every, STEP)[ok.ravel()], np.take_along_axis(ids, step, 1)[ok], seen)
        rows, nodes = (np.concatenate(p) for p in zip(*hits))
        out, open_ = [(rows, nodes)], [(rows, nodes)]
        while open_:  # every node in range is expanded
            rows, nodes = open_.pop()
            if len(rows) > _PAIRS:
                open_.append((rows[_PAIRS:], nodes[_PAIRS:]))
            rows, nodes = self._expand(rows[:_PAIRS], nodes[:_PAIRS], seen)
            s = _dots(self.x, nodes, q, rows)
            inside, close = s >= threshold, (s >= wide) & (s < threshold)
            edge.append((rows[close], nodes[close]))
            if inside.any():
                out.append((rows[inside], nodes[inside]))
                open_.append(out[-1])
        rows, nodes = (np.concatenate(p) for p in zip(*out))
        return rows, nodes, *(np.concatenate(p) for p in zip(*edge))


def _build(table: pa.Table) -> pa.Table:
    """Neighbour lists, each neighbour with its home and the edge's angle."""
    ids, homes = table.column("id").to_numpy(), table.column("home_shard").to_numpy()
    x = _unit(_vectors(table.column("embedding")))
    a, b = build_graph(x)
    angle = np.arccos(np.clip(_dots(x, a, x, b), -1, 1)).astype(np.float32).round(4)
    near = pa.StructArray.from_arrays([pa.array(ids[b]), pa.array(homes[b]), pa.array(angle)], ["id", "shard", "angle"])
    return pa.table({"id": pa.array(ids), "near": pa.ListArray.from_arrays(pa.array(np.searchsorted(a, np.arange(len(ids) + 1)), pa.int32()), near)})


def _search(threshold: float, beam: int):
    """One block's members and the queries that visit it: links, ties of linked vectors, and shards where queries go on."""
    reach = np.arccos(np.clip(threshold, -1, 1))
    wide = np.cos(min(np.pi, 2 * reach))

    def run(table: pa.Table) -> pa.Table:
        member = table.filter(table.column("member"))
        query = table.filter(pa.compute.invert(table.column("member")))
        if not member.num_rows or not query.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "links", "root", "shard", "entry")})
        member = member.take(pa.array(np.argsort(member.column("id").to_numpy())))
        shard = member.column("shard")[0].as_py()
        ids, weight, raw, lives = member.column("id").to_numpy(), member.column("n").to_numpy(), _scaled(_vectors(member.column("embedding"))), member.column("home_shard").to_numpy()
        n, norm = len(ids), np.sqrt((raw * raw).sum(1))
        near = member.column("near").combine_chunks()
        first = near.offsets.to_numpy() - near.offsets[0].as_py()
        flat = near.flatten()
        to, there, bend = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("id", "shard", "angle"))
        a = np.repeat(np.arange(n), np.diff(first))
        b = np.minimum(np.searchsorted(ids, to), n - 1)
        here = ids[b] == to
        block = _Block(raw / norm[:, None], a[here], b[here])
        # edges that lead to other shards; those to other blocks of this one aren't needed, as a query visits all of them
        away = ~here & (there != shard)
        away_start, away_to, away_shard, away_bend = np.searchsorted(a[away], np.arange(n + 1)), to[away], there[away], bend[away]
        qids, qraw = query.column("id").to_numpy(), _scaled(_vectors(query.column("embedding")))
        qnorm = np.sqrt((qraw * qraw).sum(1))

        def place(given: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(ids, given), n - 1)
            return np.where(ids[at] == given, at, -1)

        own = place(qids)
        led = query.column("entry").combine_chunks()
        led_rows, led_nodes = np.repeat(np.arange(len(qids)), np.diff(led.offsets.to_numpy())), place(led.flatten().to_numpy(zero_copy_only=False))
        start_rows, start_nodes = np.concatenate([np.arange(len(qids)), led_rows]), np.concatenate([own, led_nodes])
        known = start_nodes >= 0
        order = np.argsort(start_rows[known], kind="stable")
        start_rows, start_nodes = start_rows[known][order], start_nodes[known][order]
        links, label, go = np.zeros(len(qids), np.int64), np.arange(n + len(qids)), []
        for i in range(0, len(qids), _QUERIES):
            part = slice(i, i + _QUERIES)
            x, y = np.searchsorted(start_rows, [i, i + _QUERIES])
            rows, nodes, edge_rows, edge_nodes = block.search(qraw[part] / qnorm[part, None], start_rows[x:y] - i, start_nodes[x:y], threshold - 1e-4, wide, beam)
            rows, edge_rows = rows + i, edge_rows + i
            ok = (nodes != own[rows]) & (_dots(raw, nodes, qraw, rows) / (norm[nodes] * qnorm[rows]) >= threshold)
            self_ = nodes == own[rows]
            edge_rows, edge_nodes = np.concatenate([edge_rows, rows[self_]]), np.concatenate([edge_nodes, nodes[self_]])
            rows, nodes = rows[ok], nodes[ok]
            at_home = lives[nodes] == shard
            links += np.bincount(rows[at_home], weight[nodes[at_home]], len(qids)).astype(np.int64)
            # a linked node that lives elsewhere, and those elsewhere that near nodes' lists name: to be in range, an edge must turn by the node's angle, give or take the range's
            go.append(np.stack([rows[~at_home], lives[nodes[~at_home]], ids[nodes[~at_home]]], axis=1))
            r, v = np.concatenate([rows, edge_rows]), np.concatenate([nodes, edge_nodes])
            turn = np.arccos(np.clip(_dots(raw, v, qraw, r) / (norm[v] * qnorm[r]), -1, 1))
            many = away_start[v + 1] - away_start[v]
            at = np.repeat(away_start[v] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            may = np.abs(np.repeat(turn, many) - away_bend[at]) <= reach + 1e-3
            at, many = at[may], np.repeat(r, many)[may]
            go.append(np.stack([many, away_shard[at], away_to[at]], axis=1))
            _, keep = np.unique(np.concatenate(go)[:, :2], axis=0, return_index=True)  # one entry for each query and shard
            go = [np.concatenate(go)[keep]]
            a2, b2 = np.where(own[rows] >= 0, own[rows], n + rows), nodes
            while len(a2):  # smallest label of each group
                low = np.minimum(label[a2], label[b2])
                before = label.copy()
                np.minimum.at(label, a2, low)
                np.minimum.at(label, b2, low)
                np.minimum.at(label, before[a2], low)
                np.minimum.at(label, before[b2], low)
                label = label[label]
                if (label == before).all():
                    break
        names = np.concatenate([ids, qids])
        moved, some, go = np.flatnonzero(label != np.arange(len(label))), np.flatnonzero(links), go[0]
        none = lambda k: np.full(k, -1, np.int64)
        return pa.table({
            "id": pa.array(np.concatenate([qids[some], names[moved], qids[go[:, 0]]]).astype(np.int64)),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(moved) + len(go), np.int64)])),
            "root": pa.array(np.concatenate([qids[some], names[label[moved]], qids[go[:, 0]]]).astype(np.int64)),
            "shard": pa.array(np.concatenate([none(len(some) + len(moved)), go[:, 1]])), "entry": pa.array(np.concatenate([none(len(some) + len(moved)), go[:, 2]]))})

    return run


def _true_links(held, threshold: float):
    """Rows' share of the audited queries' links, by brute force."""

    def run(batches):
        ids, dims, vectors = held.value
        for b in batches:
            own, n, dim = b.column("id").to_numpy(), b.column("n").to_numpy(), b.column("dim").to_numpy()
            found = np.zeros(len(ids), np.int64)
            for d in np.unique(dim).tolist():
                q = np.flatnonzero(dims == d)
                if len(q):
                    at = np.flatnonzero(dim == d)
                    x, y = _scaled(_vectors(b.take(pa.array(at)).column("embedding"))), _scaled(np.stack([vectors[k] for k in q]))
                    s = (y @ x.T) / np.sqrt((y * y).sum(1))[:, None] / np.sqrt((x * x).sum(1))
                    found[q] += ((s >= threshold) & (ids[q][:, None] != own[at])) @ n[at]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], ["id", "links"])

    return run


def _members(reps: DataFrame, centres, angle: float, overlap: int) -> DataFrame:
    """dim, shard, id, n, embedding, home and home_shard of every vector in each of its shards."""
    kind = reps.schema["embedding"].dataType.simpleString()
    base = f"id long, n long, dim int, embedding {kind}, cell int, home boolean"
    cells = materialize(reps.select("id", "n", "dim", "embedding").mapInArrow(_cells(centres, overlap), base), "cells")
    sizes = materialize(cells.groupBy("dim", "cell").agg(F.count("*").alias("total")), "cell-sizes")
    large = sizes.where(F.col("total") > CELL)
    pack = lambda cell, sub: F.shiftleft(cell.cast("long"), 32).bitwiseOR(sub.cast("long"))
    if large.isEmpty():
        out = cells.withColumn("shard", pack(F.col("cell"), F.lit(0)))
    else:
        # a bounded sample of each large cell, then its centres; vectors go through in parts of a cell
        inside = cells.join(large, ["dim", "cell"])
        draw = F.pmod(F.xxhash64("id", F.lit("cell")), F.lit(1 << 30)) / float(1 << 30)
        drawn = inside.where(draw * F.col("total") < SAMPLE)
        inner = materialize(drawn.groupBy("dim", "cell").applyInArrow(_inner_centres(TARGET, angle), "dim int, cell int, centres array<double>"), "inner-centres")
        parts = F.ceil(F.col("total") / SAMPLE).cast("int")
        dealt = inside.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), parts).cast("int")).drop("total")
        copies = inner.join(large, ["dim", "cell"]).select("dim", "cell", "centres", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        keys = ("dim", "cell", "part")
        fine = dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_inner_shards(overlap), base + ", sub int")
        plain = cells.join(large, ["dim", "cell"], "left_anti").withColumn("sub", F.lit(0))
        out = materialize(fine.unionByName(plain), "fine").withColumn("shard", pack(F.col("cell"), F.col("sub")))
    homes = out.where("home").select("id", F.col("shard").alias("home_shard"))
    return materialize(out.join(homes, "id").select("dim", "shard", "id", "n", "embedding", "home", "home_shard"), "members")


def _search_shards(reps: DataFrame, centres, threshold: float, angle: float, overlap: int, beam: int) -> DataFrame:
    """id, links and root rows: a vector's links in one block (root is itself), or a tie of a vector to its group's root."""
    members = _members(reps, centres, angle, overlap)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sizes = materialize(members.groupBy("dim", "shard").agg(F.count("*").alias("m")).select("dim", "shard", blocks("m").alias("mb")), "shard-sizes")
    dealt = members.join(sizes, ["dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("mb")).cast("int")).drop("mb")
    lists = dealt.groupBy("dim", "shard", "block").applyInArrow(_build, "id long, near array<struct<id: long, shard: long, angle: float>>")
    # a list for each shard that the vector is in
    lists = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    dealt = materialize(dealt.join(lists, "id"), "graph")
    vectors = members.where("home").select("id", "dim", "n", "embedding", "home_shard")
    many = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    empty = F.array().cast("array<struct<id: long, shard: long, angle: float>>")

    def visit(asked: DataFrame, name: str) -> DataFrame:
        """asked: id, shard and entry (nodes where the walk begins). Queries of a shard take turns of about BLOCK, so many copies of its blocks."""
        rows = asked.join(vectors, "id")
        turns = materialize(rows.groupBy("dim", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("qb")), "turns")
        rows = rows.join(turns, ["dim", "shard"]).join(sizes, ["dim", "shard"])
        q = rows.select("dim", "shard", many(F.col("mb")).alias("block"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("qb")).cast("int").alias("turn"), F.lit(False).alias("member"), "home_shard", "id", "n", "embedding", empty.alias("near"), "entry")
        m = dealt.join(turns, ["dim", "shard"]).select("dim", "shard", "block", many(F.col("qb")).alias("turn"), F.lit(True).alias("member"), "home_shard", "id", "n", "embedding", "near", F.array().cast("array<long>").alias("entry"))
        return materialize(q.unionByName(m).groupBy("dim", "shard", "block", "turn").applyInArrow(_search(threshold, beam), "id long, links long, root long, shard long, entry long"), name)

    asked = vectors.select("id", F.col("home_shard").alias("shard"), F.array("id").alias("entry"))
    seen, found = [vectors.select("id", F.col("home_shard").alias("shard"))], []
    for _ in range(MAX_VISITS):
        found.append(visit(asked, "found"))
        asked = found[-1].where("shard >= 0").groupBy("id", "shard").agg(F.array_distinct(F.array(F.min("entry"), F.max("entry"))).alias("entry"))
        asked = materialize(asked.join(union_all(seen), ["id", "shard"], "left_anti"), "asked")
        if asked.isEmpty():
            return union_all(found).where("shard < 0").select("id", "links", "root")
        seen.append(asked.select("id", "shard"))
    raise RuntimeError(f"walks unfinished after {MAX_VISITS} shards in a row")


def _truth(reps: DataFrame, drawn: list, threshold: float) -> dict[int, int]:
    """True links of the drawn queries (id, dim, embedding)."""
    if not drawn:
        return {}
    held = reps.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in drawn], np.int64), np.array([r["dim"] for r in drawn], np.int64), [np.array(r["embedding"], np.float64) for r in drawn]))
    return {r["id"]: r["l"] for r in reps.mapInArrow(_true_links(held, threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("l")).collect()}


def _audit(reps: DataFrame, threshold: float) -> dict[int, int]:
    """True links of queries drawn in rounds, until LINKED of them have any."""
    truth: dict[int, int] = {}
    order = F.xxhash64("id", F.lit("audit"))
    last = None
    for _ in range(AUDIT_ROUNDS):
        left = reps if last is None else reps.where(order > last)
        drawn = left.orderBy(order).limit(AUDIT).select("id", "dim", "embedding", order.alias("o")).collect()
        if not drawn:
            break
        last = drawn[-1]["o"]
        truth |= _truth(reps, drawn, threshold)
        if sum(n > 0 for n in truth.values()) >= LINKED:
            break
    return truth


def _recall(truth: dict[int, int], got: dict[int, int]) -> float:
    """The lesser of the share of all links found and the mean of each query's share; 1 without links."""
    linked = {k: n for k, n in truth.items() if n}
    if not linked:
        return 1.0
    found = {k: min(got.get(k, 0), n) for k, n in linked.items()}
    return min(sum(found.values()) / sum(linked.values()), sum(found[k] / n for k, n in linked.items()) / len(linked))


def near_duplicates(rows: DataFrame, threshold: float = 0.95, overlap: int = OVERLAP, beam: int = BEAM, least_recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, float]:
    """vec_id, n_links, component_id of every row; and the audited share of links found."""
    spark = rows.sparkSession
    v = F.col("embedding")
    kind = rows.schema[vector_col].dataType.simpleString()
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("embedding"))
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    reps = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    reps = materialize(reps.select(F.monotonically_increasing_id().alias("id"), "low", "n", F.size("embedding").alias("dim"), "embedding"), "vectors")
    sizes = reps.groupBy("dim").agg(F.count("*").alias("c"))
    # lengths of fewer vectors have one shard, and that one block or a few
    total = {r["dim"]: r["c"] for r in sizes.where(F.col("c") > BLOCK).orderBy(F.desc("c")).limit(10_000).collect()}
    share = SAMPLE / max(1, sum(total.values()))
    drawn = F.pmod(F.xxhash64("id", F.lit("centres")), F.lit(1 << 30)) < F.lit(int(min(1, share) * (1 << 30)))
    # about SAMPLE vectors, whatever the table's size
    means = _centres(reps.where(drawn).select("dim", "embedding").limit(2 * SAMPLE).toArrow(), total)
    truth = _audit(reps, threshold)
    for attempt in range(3):
        angle = float(min(np.pi, np.arccos(np.clip(threshold, -1, 1)) * (1 + attempt)))
        centres = spark.sparkContext.broadcast({d: _apart(c, size, angle) for d, (c, size) in means.items()})
        found = _search_shards(reps, centres, threshold, angle, overlap * 2**attempt, beam * 2**attempt)
        links = materialize(found.groupBy("id").agg(F.sum("links").alias("links")), "links")
        lacking = LINKED - sum(n > 0 for n in truth.values())
        if lacking > 0:
            more = links.where("links > 0").where(~F.col("id").isin(list(truth) or [-1])).orderBy(F.xxhash64("id", F.lit("more"))).limit(lacking)
            truth |= _truth(reps, more.join(reps, "id").select("id", "dim", "embedding").collect(), threshold)
        got = {r["id"]: r["links"] for r in links.where(F.col("id").isin(list(truth) or [-1])).collect()}
        recall = _recall(truth, got)
        if recall >= least_recall:
            break
    roots = connected_components(found.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "id")
    named = materialize(reps.select("id", "low", "n").join(links, "id", "left").join(roots, "id", "left").select("id", "low", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "id").alias("root")), "named")
    # written, so that Spark may split the vectors of one root
    classes = materialize(named.groupBy("root").agg(F.min("low").alias("component")), "classes")
    named = named.join(classes, "root").select("id", (F.col("links") + F.col("n") - 1).alias("n_links"), "component")
    named = materialize(named.join(reps.select("id", F.col("embedding").alias("__v")), "id").select("__v", "n_links", "component"), "counted")
    out = rows.join(named, usable & (F.col("embedding") == F.col("__v")), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.when(F.col("__v").isNotNull(), F.col("component")), F.col("vec_id")).alias("component_id")), recall


def op6_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, recall = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    if recall < 0.9:
        raise RuntimeError(f"audited recall {recall:.3f}")
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
