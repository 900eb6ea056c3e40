"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are compared inside groups of equal label and dimension, as unit
vectors: a cosine of at least ``threshold`` is a distance of at most
sqrt(2 - 2 * threshold). Equal vectors of a group are one point with a weight.

1. A group of more than BLOCK points is dealt out by nearest pivot (points of
   the group drawn by hash, about two for each block), so a block is a region; a
   region of more than BLOCK points is dealt out again by hash. No task holds a
   group: points and pivots meet in parts of about BLOCK points.
2. Each block becomes a cover tree: nested levels with halving radii, each
   node a point that covers its subtree, each level's nodes at least its radius
   apart within their parent. A block is one row, its points in the order of the tree.
3. Blocks of one group meet in pairs unless their covering radii rule out a link
   (distance of the centres over both radii and the threshold's distance).
   Inside a pair both trees are traversed at once: a node pair beyond
   both radii and the threshold is pruned, one that lies within it whole is
   linked at once without looking at its points, one of few points is compared by
   its cosines, every other one goes on to its children.
4. A pair of blocks gives back only numbers of links by point and a spanning
   forest of its links, never the links; the components follow from the forests.

How many block pairs remain follows from the data: vectors without any
structure lie all equally far apart, so the covering radii rule out nothing
between blocks, and a block travels once for each other block of its group.

Cosines are taken in double precision; one within 1e-9 of the threshold is
taken again from exactly rounded sums of the original components.

Defined results: a vector that is null, empty, zero, or holds a null or a component that
is not finite, and one with a null label or id, links with nothing. Vectors of different
dimensions don't link. Rows that repeat a vec_id with equal label and vector are one
vector; with other vectors each row has the links of its own, and points whose smallest vec_id is
the same are in one component. A row without a vec_id is kept. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import give_back, keep
from citeweave.llm.components import components

THRESHOLD = 0.98
#: Points of a block.
BLOCK = 4096
#: Pairs of points that are compared without descending further, and rows of a matrix of cosines.
LEAF_PAIRS, ROWS = 65_536, 512
#: A node of a smaller radius is not divided; and what rounding may add to a distance.
FINEST = 1 / 64
SLACK = 1e-6
_POINTS = "grp bigint, digest binary, rep bigint, weight bigint, vector binary"
_BLOCK = "grp bigint, block bigint, n bigint, center array<double>, radius double, digests binary, reps binary, weights binary, vectors binary, nodes binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


# -- the tree -----------------------------------------------------------------

def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A cover tree of unit vectors: (order of the points, nodes, radii). A node is
    (first, last + 1, first child, last child + 1) over points in that order and over nodes;
    its centre is its first point, its radius covers all its points. Node 0 is the root."""
    order = np.arange(len(points))
    middle = points.mean(0)
    order[[0, k]] = order[[k := int((points @ middle).argmax()), 0]]
    nodes, radii = [[0, len(points), 0, 0]], [0.0]
    waiting = [(0, 2.0)]
    for node, radius in waiting:
        a, b = nodes[node][:2]
        own = order[a:b]
        far = distance(points[own] @ points[own[0]])
        radii[node] = float(far.max())
        if b - a == 1 or radii[node] < FINEST:
            continue
        while radius / 2 >= radii[node]:  # one point would cover all
            radius /= 2
        radius /= 2
        # Points in turn become centres of what they cover and nobody has yet; the parent's centre is the first.
        least = 1 - radius * radius / 2
        left, owner, count = np.arange(len(own)), np.empty(len(own), np.int64), 0
        while len(left):
            batch = left[:ROWS // 4]
            near = points[own[batch]] @ points[own[left]].T >= least
            free = np.ones(len(left), bool)
            for k in range(len(batch)):
                if free[k]:
                    mine = near[k] & free
                    mine[k] = True
                    owner[left[mine]] = count
                    free &= ~mine
                    count += 1
            left = left[free]
        by = np.argsort(owner, kind="stable")
        order[a:b] = own[by]
        size = np.bincount(owner, minlength=count)
        ends = a + np.cumsum(size)
        nodes[node][2:] = len(nodes), len(nodes) + count
        for first, last in zip((ends - size).tolist(), ends.tolist()):
            if last - first > 1:
                waiting.append((len(nodes), radius))
            nodes.append([first, last, 0, 0])
            radii.append(0.0)
    return order, np.array(nodes, np.int64), np.array(radii)


class Forest:
    """Which points are linked, directly or not: the smallest number of each one's class."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            root = np.arange(len(self.label))
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
            self.label = root[self.label]


class Links:
    """Dual traversal of the trees of two blocks, or of one with itself."""

    def __init__(self, a: dict, b: dict, threshold: float):
        self.same = a is b
        self.a, self.b, self.threshold = a, b, threshold
        self.reach = float(distance(np.float64(threshold)))
        self.count = [np.zeros(len(x["points"]), np.int64) for x in (a, b)]
        self.base = 0 if self.same else len(a["points"])  # b's points go on from a's
        self.forest = Forest(len(a["points"]) + (0 if self.same else len(b["points"])))
        self._traverse()

    def _add(self, rows: slice, columns: slice, linked: np.ndarray) -> None:
        """linked[i, j]: whether point i of rows and j of columns are linked."""
        self.count[0][rows] += linked @ self.b["weights"][columns]
        if not self.same or rows != columns:
            self.count[0 if self.same else 1][columns] += self.a["weights"][rows] @ linked
        i = np.arange(rows.start, rows.stop)
        j = np.arange(columns.start, columns.stop) + self.base
        any_i, any_j = linked.any(1), linked.any(0)
        self.forest.unite(i[any_i], j[linked.argmax(1)[any_i]])
        self.forest.unite(i[linked.argmax(0)[any_j]], j[any_j])
        apart = linked & (self.forest.label[i][:, None] != self.forest.label[j][None, :])
        if apart.any():
            x, y = np.nonzero(apart)
            self.forest.unite(i[x], j[y])

    def _compare(self, rows: slice, columns: slice) -> None:
        for first in range(rows.start, rows.stop, ROWS):
            part = slice(first, min(rows.stop, first + ROWS))
            cosine = self.a["points"][part] @ self.b["points"][columns].T
            linked = cosine >= self.threshold
            for i, j in zip(*np.nonzero(np.abs(cosine - self.threshold) < 1e-9)):
                linked[i, j] = self._exactly(part.start + i, columns.start + j)
            if self.same and rows == columns:
                linked[np.arange(part.stop - part.start), np.arange(part.start, part.stop) - columns.start] = False
                if linked.any():
                    self.count[0][part] += linked @ self.b["weights"][columns]
                    x, y = np.nonzero(linked)
                    self.forest.unite(x + part.start, y + columns.start)
            elif linked.any():
                self._add(part, columns, linked)

    def _exactly(self, i: int, j: int) -> bool:
        x, y = self.a["vectors"][i].astype(np.float64), self.b["vectors"][j].astype(np.float64)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        return math.fsum(x * y) / (math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))) >= self.threshold

    def _traverse(self) -> None:
        a, b = self.a, self.b
        waiting = [(0, 0)]
        while waiting:
            x, y = waiting.pop()
            ax, az, ac, ad = a["nodes"][x]
            bx, bz, bc, bd = b["nodes"][y]
            if (az - ax) * (bz - bx) <= LEAF_PAIRS or (ac == ad and bc == bd):
                self._compare(slice(ax, az), slice(bx, bz))
                continue
            mine = np.arange(ac, ad) if ac < ad else np.array([x])
            other = np.arange(bc, bd) if bc < bd else np.array([y])
            if self.same and x == y:
                other = mine
            for first in range(0, len(mine), ROWS):
                part = mine[first:first + ROWS]
                apart = distance(a["points"][a["nodes"][part, 0]] @ b["points"][b["nodes"][other, 0]].T)
                radii = a["radii"][part][:, None] + b["radii"][other][None, :]
                open_ = apart <= radii + self.reach + SLACK
                if self.same and x == y:  # each pair of nodes once
                    open_ &= part[:, None] <= other[None, :]
                    open_[np.arange(len(part)), np.arange(first, first + len(part))] = a["nodes"][part, 1] - a["nodes"][part, 0] > 1
                inside = open_ & (apart + radii <= self.reach - SLACK)
                if self.same and x == y:
                    inside[np.arange(len(part)), np.arange(first, first + len(part))] = False
                for i, j in zip(*np.nonzero(inside)):
                    self._whole(a["nodes"][part[i]], b["nodes"][other[j]])
                waiting += zip(part[(at := np.nonzero(open_ & ~inside))[0]].tolist(), other[at[1]].tolist())

    def _whole(self, x: np.ndarray, y: np.ndarray) -> None:
        """All points of two nodes are linked."""
        rows, columns = slice(x[0], x[1]), slice(y[0], y[1])
        self.count[0][rows] += int(self.b["weights"][columns].sum())
        self.count[0 if self.same else 1][columns] += int(self.a["weights"][rows].sum())
        i, j = np.arange(x[0], x[1]), np.arange(y[0], y[1]) + self.base
        self.forest.unite(i, np.full(len(i), j[0]))
        self.forest.unite(np.full(len(j), i[0]), j)


# -- Spark --------------------------------------------------------------------

def point_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, digest, vector) of each row; digest is null for one that links with nothing."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    dtype = np.dtype("<f4" if kind == "float" else "<f8")

    def of(batches):
        for batch in batches:
            ids, labels, lists = batch.columns
            values = lists.values.to_numpy(zero_copy_only=False).astype(dtype, copy=False)
            missing = np.cumsum(np.append(0, lists.values.is_null().to_numpy(zero_copy_only=False)))
            valid = lists.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            digest, vector, dim = [], [], []
            for i, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = values[x:y] + dtype.type(0)  # -0 is 0
                fine = valid[i] and y > x and missing[x] == missing[y] and np.isfinite(own).all() and own.any()
                data = own.tobytes() if fine else None
                name = hashlib.blake2b(str(labels[i].as_py()).encode(), digest_size=32).digest() if fine else b""
                digest.append(hashlib.blake2b(data, digest_size=16, key=name).digest() if fine else None)
                vector.append(data)
                dim.append(y - x if fine else None)
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(dim, pa.int32()), pa.array(digest, pa.binary()), pa.array(vector, pa.binary())],
                                             ["vec_id", "label", "dim", "digest", "vector"])

    label = vectors.schema["label"].dataType.simpleString()
    embedding = F.col("embedding") if dtype.itemsize == 4 else F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", embedding.alias("embedding")) \
        .mapInArrow(of, f"vec_id bigint, label {label}, dim int, digest binary, vector binary")


def blocks(points: DataFrame, dtype: np.dtype, block: int) -> DataFrame:
    """A row for each block of at most about ``block`` points of a group, with its cover tree."""
    sizes = keep(points.groupBy("grp").agg(F.count("*").alias("total")), "group-sizes").select(F.col("grp").alias("sized"), "total")
    sized = points.join(sizes, F.col("grp") == F.col("sized")).drop("sized")
    parts = F.ceil(F.col("total") / block)
    sized = keep(sized.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts"))).drop("total"), "dealt-points")
    # About two pivots for each block of a group that has several; every part of the group's points sees all of them.
    drawn = sized.where((F.col("parts") > 1) & (F.pmod(F.xxhash64("digest", F.lit(1)), F.col("parts") * F.lit(block)) < 2 * F.col("parts")))
    pivots = drawn.select("grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "digest", "vector")

    def nearest(own, pivot):
        choice = np.zeros(own.num_rows, np.int64)
        if pivot.num_rows and own.num_rows:
            pivot = pivot.sort_by("digest")  # the same number in every part
            centers = unit(np.frombuffer(b"".join(pivot["vector"].to_pylist()), dtype).reshape(pivot.num_rows, -1))
            data = np.frombuffer(b"".join(own["vector"].to_pylist()), dtype).reshape(own.num_rows, -1)
            for k in range(0, own.num_rows, ROWS):
                choice[k:k + ROWS] = (unit(data[k:k + ROWS]) @ centers.T).argmax(1)
        return pa.table({c: own[c] for c in ("grp", "digest", "rep", "weight", "vector")} | {"region": pa.array(choice)})

    regions = sized.groupBy("grp", "part").cogroup(pivots.groupBy("grp", "part")).applyInArrow(nearest, f"{_POINTS}, region bigint")
    regions = keep(regions, "regions")
    crowd = regions.groupBy("grp", "region").agg(F.ceil(F.count("*") / block).alias("split"))
    crowd = keep(crowd, "region-sizes").select(F.col("grp").alias("g"), F.col("region").alias("r"), "split")
    dealt = regions.join(crowd, (F.col("grp") == F.col("g")) & (F.col("region") == F.col("r"))) \
        .withColumn("block", F.col("region") * F.lit(1 << 32) + F.pmod(F.xxhash64("digest", F.lit(2)), F.col("split"))) \
        .select("grp", "block", "digest", "rep", "weight", "vector")

    def tree(key, own):
        own = own.sort_by("digest")
        vectors = np.frombuffer(b"".join(own["vector"].to_pylist()), dtype).reshape(own.num_rows, -1)
        points = unit(vectors)
        order, nodes, radii = build(points)
        column = lambda name: own[name].to_numpy()[order].astype("<i8").tobytes()
        digests = own["digest"].to_pylist()
        return pa.table({
            "grp": [key[0].as_py()], "block": [key[1].as_py()], "n": [len(order)], "center": [points[order[0]].tolist()], "radius": [float(radii[0])],
            "digests": [b"".join(digests[k] for k in order.tolist())], "reps": [column("rep")], "weights": [column("weight")],
            "vectors": [vectors[order].tobytes()], "nodes": [nodes.astype("<i8").tobytes() + radii.astype("<f8").tobytes()]})

    return keep(dealt.groupBy("grp", "block").applyInArrow(tree, _BLOCK), "cover-trees")


def block_pairs(trees: DataFrame, threshold: float) -> DataFrame:
    """(grp, i, j): pairs of blocks, a block with itself included, that covering radii don't rule out."""
    heads = trees.select("grp", "block", "center", "radius")
    other = heads.select(F.col("grp").alias("g"), F.col("block").alias("j"), F.col("center").alias("c"), F.col("radius").alias("s"))
    apart = F.sqrt(F.aggregate(F.zip_with("center", "c", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x))
    reach = math.sqrt(2 - 2 * threshold) + SLACK
    met = heads.join(other, (F.col("grp") == F.col("g")) & (F.col("block") <= F.col("j")))
    return met.where((F.col("block") == F.col("j")) | (apart <= F.col("radius") + F.col("s") + reach)).select("grp", F.col("block").alias("i"), "j")


def linked_points(trees: DataFrame, pairs: DataFrame, dtype: np.dtype, threshold: float) -> DataFrame:
    """(digest, links, a, b): numbers of links by point, and edges (a, b) of a forest that spans the links."""
    payload = ["digests", "reps", "weights", "vectors", "nodes"]
    first = trees.select(F.col("grp").alias("g1"), F.col("block").alias("b1"), *[F.col(c).alias(f"{c}1") for c in payload])
    second = trees.select(F.col("grp").alias("g2"), F.col("block").alias("b2"), *[F.col(c).alias(f"{c}2") for c in payload])
    met = pairs.join(first, (F.col("grp") == F.col("g1")) & (F.col("i") == F.col("b1"))) \
        .join(second, (F.col("grp") == F.col("g2")) & (F.col("j") == F.col("b2")))
    met = met.select((F.col("i") == F.col("j")).alias("same"), *[f"{c}1" for c in payload],
                     *[F.when(F.col("i") != F.col("j"), F.col(f"{c}2")).alias(f"{c}2") for c in payload])

    def read(row: list) -> dict:
        digests, reps, weights, vectors, nodes = row
        weights, reps = np.frombuffer(weights, "<i8"), np.frombuffer(reps, "<i8")
        vectors = np.frombuffer(vectors, dtype).reshape(len(reps), -1)
        many = len(nodes) // 40
        return {"digests": digests, "reps": reps, "weights": weights, "vectors": vectors, "points": unit(vectors),
                "nodes": np.frombuffer(nodes[:32 * many], "<i8").reshape(many, 4), "radii": np.frombuffer(nodes[32 * many:], "<f8")}

    def of(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                same, *row = [c[k].as_py() for c in batch.columns]
                a = read(row[:5])
                b = a if same else read(row[5:])
                found = Links(a, b, threshold)
                digest, links = [], []
                for block, count in zip([a] if same else [a, b], found.count):
                    at = np.flatnonzero(count)
                    digest += [block["digests"][16 * i:16 * i + 16] for i in at.tolist()]
                    links.append(count[at])
                reps = a["reps"] if same else np.concatenate([a["reps"], b["reps"]])
                edge = np.flatnonzero(found.forest.label != np.arange(len(reps)))
                n = len(digest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*digest, *[None] * len(edge)], pa.binary()), pa.array(np.concatenate([*links, np.zeros(len(edge), np.int64)])),
                     pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(reps[edge])]),
                     pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(reps[found.forest.label[edge]])])], ["digest", "links", "a", "b"])
        give_back()

    return met.mapInArrow(of, "digest binary, links bigint, a bigint, b bigint")


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding, label)."""
    dtype = np.dtype("<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8")
    rows = keep(point_rows(vectors), "points")
    # Rows that repeat an id and its vector are one; equal vectors of a label are one point.
    once = rows.where("digest is not null").groupBy("digest", "vec_id").agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    points = once.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("vector").alias("vector"),
                                        F.xxhash64(F.first("label"), F.first("dim")).alias("grp"))
    points = keep(points.select(*[c.split()[0] for c in _POINTS.split(", ")]), "distinct-points")
    trees = blocks(points, dtype, block)
    found = keep(linked_points(trees, block_pairs(trees, threshold), dtype, threshold), "links")
    links = found.where("digest is not null").groupBy(F.col("digest").alias("point")).agg(F.sum("links").alias("links"))
    labels = components(found.where("digest is null").select("a", "b"))
    classes = points.select("digest", "rep", "weight").join(links, F.col("digest") == F.col("point"), "left") \
        .join(labels, F.col("rep") == F.col("node"), "left") \
        .select(F.col("digest").alias("point"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component_id"))
    classes = keep(classes, "point-classes")
    out = rows.select("vec_id", "digest").join(classes, F.col("digest") == F.col("point"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
