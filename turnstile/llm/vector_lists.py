"""Approximate nearest neighbours by balanced posting lists.

Centroids come from halving a sample again and again into equal parts, so lists hold about equally many vectors. They
fit in memory, with a graph that links each to its neighbours, and the lists near a vector are found by walking that
graph. A vector on the boundary of several clusters, one almost as near to other centroids as to its own, is posted
to several lists. A query reads the lists whose centroids are near in proportion to its nearest one; how far that
proportion goes is measured, against brute force over all rows for a few vectors, so that the lists read hold
``RECALL`` of the true neighbours, whatever the size and shape of the data. There is no most number of lists.

Equal vectors are one posting with their smallest ids, so copies never fill a list. Each list is dealt to parts of
bounded work by its counts, and Spark brings a part and the queries that read its list together; a task holds one
part and one batch of queries.

On the driver: a sample of at most FIT_ROWS vectors and FIT_BYTES, at most one list per PER_CENTROID of them with its
links (broadcast), one count per list, and the neighbours of CALIBRATION vectors. Every row is posted, whatever the sample.

Defined results: a row takes part if its id is known and its vector has known, finite components, not all zero, and the
commonest number of components (of equally common ones the larger). Rows that repeat id and vector are one row. A
candidate of the query's own id is the query. Fewer than k candidates are all returned if they are found; an empty table gives no rows.
Columns other than the two named are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import written_copy

FIT_ROWS = 1 << 16
FIT_BYTES = 1 << 26
PER_CENTROID = 16  # sampled vectors per centroid, at least
PER_LIST = 200  # distinct vectors per list, while the sample allows as many lists
REPLICAS, NEAR = 4, 1.1  # lists a vector is posted to at most, and how much farther than the nearest their centroids may be
LINKS = 28  # of each centroid
BEAM = 64
CALIBRATION, RECALL = 64, 0.98
PART_ROWS, PART_WORK = 4096, 1 << 27  # postings, and distances, of one part
BATCH = 256  # vectors that walk the graph together


@dataclass
class Model:
    """Centroids, the graph over them, and the usual distance of a vector from its centroid."""

    centroids: np.ndarray
    links: np.ndarray
    radius: float


# --- the model ---------------------------------------------------------------------------------------------


def halved(points: np.ndarray, leaves: int, dice: np.random.Generator) -> list[np.ndarray]:
    """Means of as many parts of near equal size, each a half of a half, cut between two means."""
    if leaves <= 1 or len(points) < 2:
        return [points.mean(axis=0)]
    a, b = points[dice.choice(len(points), 2, replace=False)]
    left = leaves // 2
    cut = max(1, min(len(points) - 1, round(len(points) * left / leaves)))
    for _ in range(4):
        order = np.argsort(points @ (b - a), kind="stable")
        a, b = points[order[:cut]].mean(axis=0), points[order[cut:]].mean(axis=0)
    return halved(points[order[:cut]], left, dice) + halved(points[order[cut:]], leaves - left, dice)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, up to rounding."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T), 0)


def linked(centroids: np.ndarray, dice: np.random.Generator) -> np.ndarray:
    """Each centroid's nearest ones, some at random, and the next in a ring, so that all can be reached."""
    n = len(centroids)
    near = min(LINKS - 4, max(n - 1, 1))
    links = np.empty((n, near + 4), dtype=np.int32)
    for begin in range(0, n, 1024):
        block = squared(centroids[begin : begin + 1024], centroids)
        own = np.arange(len(block))
        block[own, own + begin] = np.inf
        links[begin : begin + 1024, :near] = np.argpartition(block, near - 1, axis=1)[:, :near]
    links[:, near : near + 3] = dice.integers(0, n, (n, 3))
    links[:, near + 3] = (np.arange(n) + 1) % n
    return links


def fitted(sample: np.ndarray, lists: int) -> Model:
    """A model from sampled vectors."""
    dice = np.random.default_rng(12)
    centroids = np.stack(halved(sample, lists, dice))
    model = Model(centroids, linked(centroids, dice), 0.0)
    _, distances = nearest_centroids(sample[:4096], model, 1)
    model.radius = float(np.median(distances[:, 0]))
    return model


def nearest_centroids(points: np.ndarray, model: Model, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest ``width`` centroids of each point and their distances, nearest first, by a best-first walk of the graph."""
    n = len(model.centroids)
    width = min(width, n)
    beam = min(max(width, 40), n)
    found = [_walked(points[i : i + BATCH], model, beam) for i in range(0, len(points), BATCH)]
    if not found:
        return np.empty((0, width), np.int32), np.empty((0, width))
    return np.concatenate([f[0] for f in found])[:, :width], np.concatenate([f[1] for f in found])[:, :width]


def _walked(points: np.ndarray, model: Model, beam: int) -> tuple[np.ndarray, np.ndarray]:
    b, n = len(points), len(model.centroids)
    entries = np.unique(np.linspace(0, n - 1, min(beam, n)).astype(np.int32))
    ids = np.tile(entries, (b, 1))
    dist = squared(points, model.centroids[entries])
    seen = np.zeros((b, n), dtype=bool)
    seen[:, entries] = True
    opened = np.zeros(ids.shape, dtype=bool)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    rows = np.arange(b)
    step = 4  # centroids whose links are followed at once
    while len(rows):
        closed = np.where(opened[rows], np.inf, dist[rows])
        rows = rows[np.isfinite(closed).any(axis=1)]
        if not len(rows):
            break
        closed = np.where(opened[rows], np.inf, dist[rows])
        pick = np.argsort(closed, axis=1, kind="stable")[:, :step]
        usable = np.isfinite(np.take_along_axis(closed, pick, 1))
        marks = opened[rows]
        np.put_along_axis(marks, pick, True, 1)
        opened[rows] = marks
        nodes = np.where(usable, np.take_along_axis(ids[rows], pick, 1), ids[rows][:, :1])
        reached = np.sort(model.links[nodes].reshape(len(rows), -1), axis=1)
        new = ~seen[rows[:, None], reached]
        new[:, 1:] &= reached[:, 1:] != reached[:, :-1]
        seen[rows[:, None], reached] = True
        at = np.nonzero(new)
        d = np.full(reached.shape, np.inf, dtype=dist.dtype)
        gap = points[rows[at[0]]] - model.centroids[reached[at]]
        d[at] = np.einsum("ij,ij->i", gap, gap)
        all_ids, all_d = np.concatenate([ids[rows], reached], 1), np.concatenate([dist[rows], d], 1)
        all_open = np.concatenate([opened[rows], ~new], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, : ids.shape[1]]
        ids[rows], dist[rows] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_d, order, 1)
        opened[rows] = np.take_along_axis(all_open, order, 1)
    return ids, np.sqrt(dist)


def lists_within(points: np.ndarray, model: Model, ratio: float) -> list[np.ndarray]:
    """The lists that each point reads: centroids within ``ratio`` of the nearest one's distance, or of the usual radius where that is more."""
    found: list[np.ndarray] = [np.empty(0, np.int32)] * len(points)
    todo, width = np.arange(len(points)), BEAM
    while len(todo):
        ids, dist = nearest_centroids(points[todo], model, width)
        reach = ratio * np.maximum(dist[:, :1], model.radius)
        inside = dist <= reach
        inside[:, 0] = True
        # A full beam may hide more lists: look again, farther.
        more = inside.all(axis=1) & (ids.shape[1] < len(model.centroids))
        for i in np.nonzero(~more)[0]:
            found[todo[i]] = ids[i][inside[i]]
        todo, width = todo[more], width * 2
    return found


def replicas(points: np.ndarray, model: Model) -> list[np.ndarray]:
    """The lists that each vector is posted to: its nearest, and others almost as near."""
    ids, dist = nearest_centroids(points, model, REPLICAS)
    return [i[(d <= NEAR * d[0]) | (np.arange(len(d)) == 0)] for i, d in zip(ids, dist, strict=True)]


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, in double precision; the same for equal pairs wherever they stand."""
    gap = a.astype(np.float64) - b.astype(np.float64)
    return np.sqrt((gap * gap).sum(axis=-1))


def closest(queries: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact distances of the k nearest vectors, and of all that tie with the last."""
    rough = squared(queries, vectors)
    scale = (queries * queries).sum(axis=1) + (vectors * vectors).sum(axis=1).max()
    for i, query in enumerate(queries):
        # Sums beyond double precision say nothing: then all are compared exactly.
        kth = np.partition(rough[i], k - 1)[k - 1] if len(vectors) > k and np.isfinite(rough[i]).all() else np.inf
        places = np.nonzero((rough[i] <= kth + 1e-9 * scale[i]) | (kth == np.inf))[0]
        yield places, exact_distances(query[None], vectors[places])


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """List arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


# --- rows --------------------------------------------------------------------------------------------------


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = df.where(F.col(vec_id).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    return known.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))


def mark(vector: Column, seed: int) -> Column:
    """An even draw from 0 to 1 that a vector always gets."""
    return F.pmod(F.xxhash64(F.lit(seed), vector), F.lit(1 << 30)) / F.lit(float(1 << 30))


def folded(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with the smallest k + 1 ids of each; copies are left out before the shuffle."""
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    ranked = rows.withColumn("place", F.dense_rank().over(smallest)).where(F.col("place") <= k + 1)
    return ranked.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


def model_of(rows: DataFrame) -> tuple[Model, int] | None:
    """A model from a sample of the distinct vectors, and their number of components; None without rows."""
    counted = rows.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), F.approx_count_distinct("vector").alias("distinct"))
    commonest = counted.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not commonest:
        return None
    dims, distinct = commonest[0]["dims"], max(commonest[0]["distinct"], 1)
    most = max(2, min(FIT_ROWS, FIT_BYTES // (8 * dims)))
    drawn = rows.where((F.size("vector") == dims) & (mark(F.col("vector"), 1) <= 0.9 * most / distinct)) if distinct > 0.9 * most else rows.where(F.size("vector") == dims)
    sample = drawn.select("vector").distinct().limit(most).toArrow()
    points = matrix(sample.column(0).combine_chunks(), dims)
    points = points[np.lexsort(points.T)]  # whatever order the rows came in
    return fitted(points, max(1, min(math.ceil(distinct / PER_LIST), len(points) // PER_CENTROID))), dims


def posted(vectors: DataFrame, model: Model, dims: int) -> DataFrame:
    """The index: distinct vectors with their ids and the lists they are posted to."""
    held = vectors.sparkSession.sparkContext.broadcast((model.centroids, model.links, model.radius))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model(*held.value)
        for batch in batches:
            lists = replicas(matrix(batch.column(0), dims), local)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["vector", "ids", "lists"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return written_copy(vectors.select("vector", "ids").mapInArrow(assigned, f"vector {kind}, ids array<bigint>, lists array<int>"), "postings")


def measured_ratio(index: DataFrame, model: Model, dims: int, k: int) -> float:
    """How far queries must reach to find RECALL of the true neighbours, from brute force for a few vectors."""
    drawn = index.select("vector").orderBy(F.xxhash64(F.lit(2), "vector"), "vector").limit(CALIBRATION).toArrow()
    points = matrix(drawn.column(0).combine_chunks(), dims)
    held = index.sparkSession.sparkContext.broadcast(points)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = held.value
        for batch in batches:
            vectors = matrix(batch.column(0), dims)
            lists = batch.column(1).to_pylist()
            found = [(i, float(d), lists[p]) for i, (places, ds) in enumerate(closest(local, vectors, k + 1)) for p, d in zip(places, ds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.list_(pa.int32()))],
                names=["drawn", "distance", "lists"],
            )

    near = index.select("vector", "lists").mapInArrow(compared, "drawn int, distance double, lists array<int>")
    place = F.row_number().over(Window.partitionBy("drawn").orderBy("distance", "lists"))
    # The first is the vector itself.
    true = near.withColumn("place", place).where(F.col("place").between(2, k + 1)).collect()
    if not true:
        return 1.0
    _, nearest = nearest_centroids(points, model, 1)
    reach = np.maximum(nearest[:, 0], model.radius)
    far = [exact_distances(points[t["drawn"]][None], model.centroids[t["lists"]]).min() / max(reach[t["drawn"]], 1e-30) for t in true]
    return float(max(1.0, np.quantile(far, RECALL, method="higher") * (1 + 1e-6)))


def reading(queries: DataFrame, model: Model, dims: int, ratio: float) -> DataFrame:
    """Distinct query vectors, numbered, with the lists they read; written, so that the numbers stay."""
    held = queries.sparkSession.sparkContext.broadcast((model.centroids, model.links, model.radius))
    numbered = queries.select("vector").distinct().select(F.monotonically_increasing_id().alias("query"), "vector")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model(*held.value)
        for batch in batches:
            lists = lists_within(matrix(batch.column(1), dims), local, ratio)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["query", "vector", "lists"])

    kind = queries.schema["vector"].dataType.simpleString()
    return written_copy(numbered.mapInArrow(chosen, f"query bigint, vector {kind}, lists array<int>"), "readers")


def parts_of(index: DataFrame, readers: DataFrame) -> DataFrame:
    """Into how many parts each list is dealt: by its postings, and by its postings times its readers."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias(name))

    work = F.col("postings") * F.col("readers")
    parts = F.ceil(F.greatest(F.col("postings") / PART_ROWS, work / PART_WORK)).cast("int")
    return counted(index, "postings").join(counted(readers, "readers"), "list").select("list", parts.alias("parts"))


def compared_lists(index: DataFrame, readers: DataFrame, dims: int, k: int) -> DataFrame:
    """query, distance, vec_id: of each part of each list read, the k + 1 nearest."""
    parts = written_copy(parts_of(index, readers), "parts")  # at most one row a list
    nothing = F.lit(None)
    postings = index.select("vector", "ids", F.explode("lists").alias("list")).join(parts, "list")
    postings = postings.select("list", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int").alias("part"), nothing.cast("long").alias("query"), "vector", "ids")
    asked = readers.select("query", "vector", F.explode("lists").alias("list")).join(parts, "list")
    asked = asked.select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query", "vector", nothing.cast("array<bigint>").alias("ids"))
    # Postings have no query number, so they stream before the queries of their part.
    stream = postings.unionByName(asked).repartition("list", "part").sortWithinPartitions("list", "part", F.asc_nulls_first("query"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, vectors, ids = None, [], []
        held = np.empty((0, dims))
        for batch in batches:
            here = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)
            asks = ~np.asarray(batch.column(2).is_null())
            points = matrix(batch.column(3), dims)
            query, own = batch.column(2).to_pylist(), batch.column(4)
            starts = np.nonzero(np.r_[True, (here[1:] != here[:-1]).any(axis=1) | (asks[1:] != asks[:-1])])[0] if len(here) else []
            out: tuple[list, list, list] = ([], [], [])
            for begin, end in zip(starts, [*starts[1:], len(here)], strict=True):
                if not asks[begin]:
                    if tuple(here[begin]) != place:
                        place, vectors, ids = tuple(here[begin]), [], []
                    vectors.append(points[begin:end])
                    ids += own[begin:end].to_pylist()
                    held = np.concatenate(vectors)
                elif tuple(here[begin]) == place:
                    for row in range(begin, end, BATCH):
                        block = points[row : min(row + BATCH, end)]
                        for i, (places, distances) in enumerate(closest(block, held, k + 1)):
                            best = sorted((d, v) for p, d in zip(places, distances.tolist(), strict=True) for v in ids[p])[: k + 1]
                            out[0].extend([query[row + i]] * len(best))
                            out[1].extend(d for d, _ in best)
                            out[2].extend(v for _, v in best)
            arrays = [pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.float64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "distance", "vec_id"])

    return stream.mapInArrow(searched, "query bigint, distance double, vec_id bigint")


def nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows found, nearest first, ties to the smaller id.

    ``rows`` and ``queries`` are of ``usable``; a row of a query's own id is not its neighbour.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    fit = model_of(rows)
    if fit is None:
        return rows.sparkSession.createDataFrame([], schema)
    model, dims = fit
    index = posted(folded(rows.where(F.size("vector") == dims), k), model, dims)
    queries = queries.where(F.size("vector") == dims)
    readers = reading(queries, model, dims, measured_ratio(index, model, dims, k))
    found = compared_lists(index, readers, dims, k)
    # Replicas of one neighbour rank alike, and the limit holds before the shuffle too.
    place = F.dense_rank().over(Window.partitionBy("query").orderBy("distance", "vec_id"))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("query").agg(F.array_sort(F.collect_set(F.struct("distance", "vec_id"))).alias("best"))
    answers = readers.join(best, "query").select("vector", "best")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector").distinct()
    ranked = asked.join(answers, "vector").select("query_id", F.posexplode(others).alias("rank", "near"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("near.vec_id").alias("vec_id"), F.col("near.distance").alias("score"))
