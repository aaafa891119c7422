"""Approximate nearest neighbours by multiprobe p-stable hashing, reranked exactly.

Vectors are scaled to length 1 and hashed, in each of TABLES tables, to the cells of width WIDTH of M Gaussian projections.
A query visits, in each table, the cells with the largest estimated chance to hold its neighbours: the cells' offsets are
ordered by the product of the Gaussian probabilities of their intervals, given the distance of neighbours. M follows from
the number of rows, so that a bucket keeps about BUCKET of them; the number of cells visited is the smallest that finds
RECALL of the true neighbours in a sample of at most SAMPLE rows (whose neighbours are farther than those among all rows, so
that recall over all rows is no lower). Where MOST_PROBES cells do not find RECALL, M is lowered until they do: buckets grow
instead, down to one that holds all rows (M = 0), which is exact. Buckets of more than SPLIT rows are salted, and no pairs leave a task but the best of
each query among all buckets of the task.

Equal vectors are indexed up to k + 1 times, by smallest id: more of them can never be among the k nearest. Equal queries
are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import in_arrow, kept, pick

TABLES = 4
WIDTH = 1.0
REACH = 3
BUCKET = 100
SPLIT = 4096
SAMPLE = 4096
RECALL = 0.97
MOST_PROBES = 400
_VECTOR = pa.list_(pa.float64())


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same two vectors always give the same number."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _normal(x: np.ndarray) -> np.ndarray:
    """Normal distribution function (Abramowitz and Stegun 7.1.26; good enough to order cells)."""
    z = np.abs(x) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    erf = 1 - t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-z * z)
    return 0.5 * (1 + np.sign(x) * erf)


class Hashing:
    """TABLES tables of ``m`` projections for vectors of one length."""

    def __init__(self, length: int, m: int, distance: float, probes: int = MOST_PROBES):
        rng = np.random.default_rng([length, m, 5])
        self.m, self.distance, self.probes = m, distance, probes
        self.lines = rng.normal(size=(TABLES, m, length))
        self.shifts = rng.uniform(0, WIDTH, (TABLES, m))
        self.places = rng.integers(1, 2**62, max(m, 1)) | 1

    def positions(self, u: np.ndarray, table: int) -> np.ndarray:
        return (u @ self.lines[table].T + self.shifts[table]) / WIDTH

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """One number per row of cells (last axis)."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.places[: self.m]).sum(axis=-1)

    def offsets(self, positions: np.ndarray) -> np.ndarray:
        """For each query the offsets of the cells to visit, likeliest first: (queries, probes, m)."""
        n = len(positions)
        steps = np.arange(-REACH, REACH + 1)
        inside = positions - np.floor(positions)
        best, chosen = np.zeros((n, 1)), np.zeros((n, 1, 0), np.int8)
        for i in range(self.m):
            low = (steps - inside[:, i : i + 1]) * WIDTH / self.distance
            chance = np.log(np.maximum(_normal(low + WIDTH / self.distance) - _normal(low), 1e-12))
            total = (best[:, :, None] + chance[:, None, :]).reshape(n, -1)
            order = np.argsort(-total, axis=1, kind="stable")[:, : self.probes]  # the best sums only use the best parts
            best = np.take_along_axis(total, order, axis=1)
            chosen = np.concatenate([np.take_along_axis(chosen, (order // len(steps))[:, :, None], axis=1),
                                     steps[order % len(steps)][:, :, None].astype(np.int8)], axis=2)
        return chosen


def fitted(length: int, rows: int, sample: np.ndarray, k: int) -> Hashing:
    """Hashing for ``rows`` vectors, its probes fitted to the sample; of so few projections that MOST_PROBES suffice for RECALL."""
    m = int(np.clip(round(np.log(max(rows, 1) / BUCKET) / np.log(5)), 0, 12))
    if not m or len(sample) <= k + 1:
        return Hashing(length, 0, 1.0, 1)
    u = unit(sample)
    queries = np.arange(min(256, len(u)))
    near = u[queries] @ u.T
    near[queries, queries] = -2
    true = np.argsort(-near, axis=1)[:, :k]
    distance = float(np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, true, axis=1), 1e-6)).mean())
    for fewer in range(m, 0, -1):
        hashing = Hashing(length, fewer, distance)
        first = np.full(true.shape, MOST_PROBES)
        for table in range(TABLES):
            cells = hashing.positions(u, table)
            offsets = hashing.offsets(cells[queries])
            apart = np.floor(cells)[true] - np.floor(cells[queries])[:, None, :]
            same = (offsets[:, None, :, :] == apart[:, :, None, :]).all(axis=3)
            first = np.minimum(first, np.where(same.any(axis=2), same.argmax(axis=2), MOST_PROBES))
        last = int(np.sort(first.ravel())[int(np.ceil(RECALL * first.size)) - 1])
        if last < MOST_PROBES:
            hashing.probes = last + 1
            return hashing
    return Hashing(length, 0, 1.0, 1)


def _entries(hashings: dict[int, Hashing], query: bool):
    """(length, table, bucket, id, v) of each vector: one row per table, for queries one per cell to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for begin in range(0, big.num_rows, 500):
                batch = big.slice(begin, 500)
                lengths = batch.column("length").to_numpy()
                for length in np.unique(lengths).tolist():
                    part, h = batch.filter(pa.array(lengths == length)), hashings[length]
                    u = unit(matrix(part.column("v")))
                    for table in range(TABLES if h.m else 1):
                        at = np.floor(cells := h.positions(u, table)) if h.m else np.zeros((len(u), 0))
                        if query:
                            buckets = h.buckets(at[:, None, :] + h.offsets(cells)) if h.m else np.zeros((len(u), 1), np.int64)
                        else:
                            buckets = h.buckets(at)[:, None]
                        rows = pa.array(np.repeat(np.arange(len(u)), buckets.shape[1]))
                        out = part.select(["length", "id", "v"]).take(rows)
                        out = out.append_column("tab", pa.array(np.full(len(rows), table)))
                        yield out.append_column("bucket", pa.array(buckets.ravel()))

    return run


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by bucket, those of the index first: the k best of this task's buckets for each query."""
        key, ids, parts = None, [], []
        found = _Best(k)
        for batch in batches:
            names = ("length", "tab", "bucket", "salt", "query")
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if batch.num_rows > 1 else np.zeros(0, int)
            limits = [0, *change.tolist(), batch.num_rows]
            for begin, end in zip(limits[:-1], limits[1:]):
                if begin == end:
                    continue
                own = tuple(int(c[begin]) for c in columns[:4])
                if own != key:
                    key, ids, parts = own, [], []
                part = batch.slice(begin, end - begin)
                if not columns[4][begin]:
                    ids.append(part.column("id").to_numpy())
                    parts.append(matrix(part.column("v")))
                elif ids:
                    if len(ids) > 1:
                        ids, parts = [np.concatenate(ids)], [np.concatenate(parts)]
                    found.add(part.column("id").to_numpy(), matrix(part.column("v")), ids[0], parts[0])
                    if found.full:
                        yield found.taken()
        yield found.taken()

    return run


class _Best:
    """The k best found so far of each query, as arrays that are cut down from time to time and handed on when too many."""

    def __init__(self, k: int, most: int = 400_000):
        self.k, self.most = k, most
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        u = unit(rows).T
        for begin in range(0, len(queries), 256):
            own = queries[begin : begin + 256]
            rough = unit(own) @ u
            if rough.shape[1] > 2 * self.k + 8:
                limit = -np.partition(-rough, self.k - 1, axis=1)[:, self.k - 1 : self.k] - 1e-9  # and all that may equal the last
                q, at = np.nonzero(rough >= limit)
            else:
                q, at = np.divmod(np.arange(rough.size), rough.shape[1])
            self.rows.append((query_ids[begin + q], ids[at], cosines(own[q], rows[at])))
            self.n += len(q)
            if self.n > self.most:
                self.cut()

    def cut(self) -> None:
        if not self.rows:
            return
        q, v, s = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((-s, v, q))
        first = np.ones(len(order), bool)  # a pair met in several tables counts once
        first[1:] = (q[order][1:] != q[order][:-1]) | (v[order][1:] != v[order][:-1])
        q, v, s = (c[order][first] for c in (q, v, s))
        order = np.lexsort((v, -s, q))
        start = np.ones(len(order), bool)
        start[1:] = q[order][1:] != q[order][:-1]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))
        stay = order[place < self.k]
        self.rows, self.n = [(q[stay], v[stay], s[stay])], len(stay)

    @property
    def full(self) -> bool:
        return self.n > self.most // 2 and len(self.rows) == 1

    def taken(self) -> pa.RecordBatch:
        self.cut()
        q, v, s = self.rows[0] if self.rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.rows, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], ["query_id", "vec_id", "score"])


def _search(index: DataFrame, queries: DataFrame, hashings: dict[int, Hashing], k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best found of each query."""
    schema = "length int, id long, v array<double>, tab long, bucket long"
    keys = ["length", "tab", "bucket"]
    entries, visits = in_arrow(index, _entries(hashings, False), schema), in_arrow(queries, _entries(hashings, True), schema)
    salts = kept(entries.groupBy(*keys).agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("salts")))
    entries = entries.join(salts, keys).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).withColumn("query", F.lit(0))
    visits = visits.join(salts, keys).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("query", F.lit(1))
    columns = [*keys, "salt", "query", "id", "v"]
    rows = entries.select(columns).union(visits.select(columns)).repartition(*keys, "salt").sortWithinPartitions(*keys, "salt", "query")
    found = in_arrow(rows, _searched(k), "query_id long, vec_id long, score double")
    return _ranked(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k).drop("rank")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every``: query_id, rank (from 1), vec_id, score of its ``k`` nearest found among
    all other rows, by cosine in double precision, ties to the smaller id; all candidates if they are fewer.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do rows with a NULL id. Only
    vectors of the same length are compared. Rows that share an id are one query and one candidate, with their best score. A
    query for which too few are found is searched again over all rows. An empty table gives no rows; other columns are not read.
    """
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = pick(vectors, id=vec_id, v=embedding).select(F.col("id").cast("long").alias("id"), v.cast("array<double>").alias("v")) \
        .where("id is not null and v is not null").where(F.coalesce(fine, F.lit(False))).select("id", "v", F.size("v").alias("length"))
    same = Window.partitionBy("v").orderBy("id")
    index = kept(rows.distinct().withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1).select("id", "v", "length"))
    asked = rows.where(F.col("id") % every == 0).distinct()
    queries = kept(asked.groupBy("v", "length").agg(F.min("id").alias("id")))
    hashings, there = {}, {}
    for length, count in index.groupBy("length").count().toLocalIterator():  # one row per length of vectors
        sample = index.where(F.col("length") == length).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
        hashings[length] = fitted(length, count, matrix(sample.column("v").combine_chunks()), k)
        there[length] = count
    if not hashings:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = kept(_search(index, queries, hashings, k + 1))
    enough = found.groupBy("query_id").agg(F.count("*").alias("n"))
    limits = F.coalesce(F.create_map(*[F.lit(x) for kv in there.items() for x in kv])[F.col("length")], F.lit(0))
    short = kept(queries.join(enough, F.col("id") == F.col("query_id"), "left").where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), limits)).select("id", "v", "length"))
    again = _search(index, short, {length: Hashing(length, 0, 1.0, 1) for length in hashings}, k + 1)
    found = found.union(again).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumnRenamed("query_id", "class")
    members = asked.join(queries.select("v", F.col("id").alias("class")), "v").select(F.col("id").alias("query_id"), "class")
    every_one = members.join(found, "class").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _ranked(every_one, k).select("query_id", "rank", "vec_id", "score")
