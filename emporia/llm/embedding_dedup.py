"""Near-duplicate embeddings by cross-polytope hashing.

Equal vectors of a label form a class with one representative.  In each of
several tables a representative is rotated by rounds of random signs and fast
Hadamard transforms, a few times independently; the largest coordinate of each
rotation, with its sign, is the vertex of the cross-polytope nearest to it, and
the vertices together are its bucket.  Multiprobe: it is also entered in the
buckets that differ in the one vertex that was nearly chosen.  Two vectors are
candidates where a bucket is the own one of either.

Buckets without a candidate pair are dropped before any vector is moved.  The
members of the others are compared block by block in tasks, by cosine in
double precision; a bucket of any size is dealt over its pairs of blocks.  A
pair met in several buckets counts in the first only, so links are summed per
vector where they are found and never written out as pairs; a block reports
the connections it found as one edge per member.

The number of tables follows from the vectors' lengths: the share of random
pairs exactly at the threshold that one table misses is measured when the plan
is made (0.24 at cosine 0.98 in 64 dimensions), and so many tables are taken
that all of them miss a pair with a probability of at most 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.blocks import deal_blocks, groups_of, matrix
from emporia.llm.common import seeds, splitmix, written
from emporia.llm.components import connected_components
from emporia.session import ship_package

BLOCK, STRIPE = 2048, 64
#: Vertices of a rotation that are considered, nearest first.
NEAREST = 4
#: Vectors of fewer coordinates are first turned into a random subspace of as
#: many: signs and Hadamard transforms alone make only a few different
#: partitions of them, padded with zeros or not.
LEAST_WIDTH = 16
#: Probability that all tables miss a pair exactly at the threshold, and the
#: least number of tables.
MISS, LEAST_TABLES = 1e-6, 10


def fast_hadamard(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x


def bucket_keys(x: np.ndarray, salt: np.ndarray, tables: int, rotations: int, probes: int) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket numbers: the own bucket, then those
    probed, in order of how nearly they were the own one."""
    n, dim = x.shape
    width = max(LEAST_WIDTH, 1 << max(0, (dim - 1).bit_length()))
    if dim >= LEAST_WIDTH:
        x = np.pad(x, ((0, 0), (0, width - dim)))
    near = min(NEAREST, width)
    out = np.empty((n, tables, 1 + probes), np.uint64)
    place = (2 * width) ** np.arange(rotations, dtype=np.int64)
    for t in range(tables):
        vertex = np.empty((n, rotations, near), np.int64)
        size = np.empty((n, rotations, near))
        for r in range(rotations):
            y = x if dim >= LEAST_WIDTH else x @ np.linalg.qr(
                np.random.default_rng((dim, t, r)).normal(size=(LEAST_WIDTH, dim)))[0].T
            for turn in range(3):
                signs = np.where(seeds(width, 1000 + (t * rotations + r) * 3 + turn) >> np.uint64(63), 1.0, -1.0)
                y = fast_hadamard(y * signs)
            order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            vertex[:, r] = order * 2 + (np.take_along_axis(y, order, 1) < 0)
            size[:, r] = np.abs(np.take_along_axis(y, order, 1))
        own = vertex[:, :, 0]
        loss = (size[:, :, :1] - size[:, :, 1:]).reshape(n, -1)
        rank = np.argsort(loss, axis=1, kind="stable")
        for k in range(1 + probes):
            code = own.copy()
            if k and k <= loss.shape[1]:
                which = rank[:, k - 1]
                r, m = which // max(1, near - 1), which % max(1, near - 1) + 1
                code[np.arange(n), r] = vertex[np.arange(n), r, m]
            out[:, t, k] = splitmix(splitmix((code @ place).astype(np.uint64) + np.uint64(t) * seeds(1, 41)) ^ salt)
    return out


def pairs_at(threshold: float, n: int, dim: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``n`` random pairs of unit vectors whose cosine is the threshold."""
    rng = np.random.default_rng(seed)
    a, o = rng.normal(size=(n, dim)), rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o -= (o * a).sum(axis=1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    return a, threshold * a + np.sqrt(1 - threshold ** 2) * o


def tables_for(dim: int, threshold: float, rotations: int, probes: int) -> int:
    """Tables that miss a pair of this length with probability ``MISS`` at most."""
    if dim < 2 or not 0 < threshold < 1:
        return LEAST_TABLES
    n = int(np.clip((1 << 18) // dim, 500, 4000))
    with np.errstate(over="ignore"):
        a, b = (bucket_keys(x, np.zeros(n, np.uint64), 3, rotations, probes) for x in pairs_at(threshold, n, dim))
    missed = 1 - ((b == a[:, :, :1]).any(axis=2) | (a == b[:, :, :1]).any(axis=2)).mean()
    missed = min(missed + np.sqrt(missed * (1 - missed) / (3 * n)), 1 - 1 / (3 * n))
    return LEAST_TABLES if missed <= 0 else max(LEAST_TABLES, int(np.ceil(np.log(MISS) / np.log(missed))))


def _buckets(classes: DataFrame, tables: int, rotations: int, probes: int) -> DataFrame:
    """(rep, keys): ``tables`` own buckets, then ``probes`` for each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                salt = batch.column(1).to_numpy().view(np.uint64)
                vectors = batch.column(2)
                sizes = np.array([len(v) for v in vectors], np.int64)
                keys = np.empty((batch.num_rows, tables, 1 + probes), np.uint64)
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    x = vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim).astype(np.float64)
                    keys[at] = bucket_keys(x, salt[at], tables, rotations, probes)
                flat = np.concatenate([keys[:, :, 0], keys[:, :, 1:].reshape(len(keys), -1)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]),
                        pa.array(flat.reshape(-1).view(np.int64)))], ["rep", "keys"])

    kind = classes.schema["rep"].dataType.simpleString()
    return classes.select("rep", F.xxhash64("label", F.size("vec")).alias("salt"), "vec").mapInArrow(
        run, f"rep {kind}, keys array<long>")


def _merge(i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
    """Smallest position each position is connected to by the pairs (i, j)."""
    low = np.arange(size)
    while len(i):
        a, b = low[i], low[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    return low


def _compare(members: DataFrame, threshold: float, tables: int) -> DataFrame:
    """(a, b, n): n more links of a (b null), or a and b connected (n null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in groups_of(batches):
            rep, count = rows.column("rep").combine_chunks(), rows.column("n").to_numpy()
            keys = matrix(rows, "keys")
            own, all_keys = keys[:, :tables], keys
            probed = np.concatenate([own[:, :, None], all_keys[:, tables:].reshape(len(keys), tables, -1)], axis=2)
            size, links = rows.num_rows, np.zeros(rows.num_rows)
            first, second = [], []
            for key, one, two in found:
                if len(one) == 0 or len(two) == 0 or (one is two and len(one) < 2):
                    continue
                x = matrix(rows.take(pa.array(one)), "vec").astype(np.float64)
                y = x if one is two else matrix(rows.take(pa.array(two)), "vec").astype(np.float64)
                length = [np.sqrt(np.einsum("ij,ij->i", v, v)) for v in (x, y)]
                for k in range(0, len(one), STRIPE):
                    cos = (x[k:k + STRIPE] @ y.T) / (length[0][k:k + STRIPE, None] * length[1])
                    i, j = np.nonzero(cos >= threshold)
                    i, j = one[i + k], two[j]
                    if one is two:
                        i, j = i[i < j], j[i < j]
                    if not len(i):
                        continue
                    # the first table in which they met, and the bucket that counts there
                    mine = (probed[j] == own[i][:, :, None]).any(axis=2)
                    yours = (probed[i] == own[j][:, :, None]).any(axis=2)
                    met = mine | yours
                    t = np.argmax(met, axis=1)
                    at = np.arange(len(i))
                    a = np.where(mine[at, t], own[i, t], np.iinfo(np.int64).max)
                    b = np.where(yours[at, t], own[j, t], np.iinfo(np.int64).max)
                    here = np.minimum(a, b) == key
                    i, j = i[here], j[here]
                    links += np.bincount(i, count[j], size) + np.bincount(j, count[i], size)
                    root = _merge(i, j, size)
                    moved = np.flatnonzero(root != np.arange(size))
                    first.append(moved)
                    second.append(root[moved])
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(some)), pa.nulls(len(some), rep.type),
                     pa.array(links[some].astype(np.int64))], ["a", "b", "n"])
            if first:
                a, b = np.concatenate(first), np.concatenate(second)
                root = _merge(a, b, size)
                moved = np.flatnonzero(root != np.arange(size))
                yield pa.RecordBatch.from_arrays(
                    [rep.take(pa.array(moved)), rep.take(pa.array(root[moved])),
                     pa.nulls(len(moved), pa.int64())], ["a", "b", "n"])

    kind = members.schema["rep"].dataType.simpleString()
    return deal_blocks(members, BLOCK).mapInArrow(run, f"a {kind}, b {kind}, n long")


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.98, tables: int | None = None,
                    rotations: int = 3, probes: int = 2) -> DataFrame:
    """One row per input row: the identifier, ``n_links`` (other vectors of
    its label with a cosine of at least ``threshold``), ``component_id``
    (smallest identifier reachable by links, itself included) and ``kept``.

    A vector that is null, empty or zero, or holds a null or non-finite
    component, links with nothing, nor does a row with a null label or
    identifier: 0 links, its own component, kept.  Vectors of different
    lengths don't link.  Rows that repeat an identifier are vectors of their
    own.  Other columns are not read; an empty table gives an empty result.
    ``tables`` None: as many as the shortest and the longest vector need.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vec"))
    big = F.aggregate("vec", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v)))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
            & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & (big > 0))
    # scaled by the largest component, so that no square over- or underflows
    scaled = F.transform("vec", lambda v: v / big)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False))).select(
        "id", "good", F.when(F.col("good"), F.col("label")).alias("label"),
        F.when(F.col("good"), scaled).alias("vec"))
    cls = ["label", "vec"]
    classes = written(rows.where("good").groupBy(*cls).agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "embedding-classes")
    if tables is None:
        ends = classes.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
        tables = max((tables_for(d, threshold, rotations, probes) for d in set(ends) if d), default=LEAST_TABLES)
    keys = written(_buckets(classes, tables, rotations, probes), "embedding-keys")
    entered = keys.select("rep", F.posexplode("keys").alias("pos", "key"))
    entered = entered.groupBy("key", "rep").agg(F.max(F.col("pos") < tables).alias("own"))
    # written, so that neither side of the join is an aggregate and a hot bucket can be split
    shared = written(entered.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("any")).where(
        "any and m > 1").select("key", "m"), "embedding-buckets")
    members = entered.select("key", "rep").join(shared, "key").join(keys, "rep").join(
        classes.select("rep", "n", "vec"), "rep")
    found = written(_compare(members, threshold, tables), "embedding-links")
    nodes = connected_components(found.where("n is null"))
    links = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("more"))
    known = (classes.select(*cls, "rep", "n").join(links, F.col("rep") == F.col("a"), "left")
             .join(nodes, F.col("rep") == F.col("node"), "left")
             .select(*cls, (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component")))
    joined = rows.select("id", *cls).join(known, cls, "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
