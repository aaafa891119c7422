"""Jaccard join of documents over their sets of five-word shingles, in the metric space of the Jaccard distance.

1. Documents with the same set are one class from the start.
2. A class meets others in regions, one for each shingle of its *window*: its first shingles in one fixed order, with very
   common shingles last. Two sets that link share at least one shingle of their windows: a set can miss at most a quarter of
   its shingles in the other, so a quarter plus one of them always suffices; where more than a quarter are uncommon, so many
   of the uncommon ones suffice that a linked pair goes unmet with a chance below 1e-14, less than that of two 64-bit hashes
   being equal somewhere.
3. Each region elects as *pivot* the class with the smallest share of uncommon shingles, the middle of its surroundings. Distances to the
   pivots are exact; classes within the radius link to the pivot and need no further test among each other: the pivot joins
   them. This takes one comparison per class in place of all pairs of a group.
4. The classes of a region outside its pivot's radius are joined again with that region, but only where the triangle
   inequality leaves room: a pair whose distances to the pivot differ by more than the radius cannot link. In the region of
   a common shingle, a pair is also left out if it could link only by sharing uncommon ones: a window that reaches a common
   shingle holds all its uncommon ones, so such a pair meets in the region of one of these.
5. Links become components; a class passes its component to its documents.

Plain Voronoi cells of a few pivots would not do: texts that share no shingle have distance 1 from each other, so nearly
all texts are equally far from all pivots, and windows of twice the radius would copy each text into each cell. Cells are
therefore formed per shared shingle.

Before sets are compared, 128-bit sketches (one bit of the smallest hash of each of 128 parts of the hash space) rule pairs
out: a shingle that only one set has changes at most one bit, and by chance over 52 of 128 bits differ in a linked pair with
a probability below 1e-14. Quarters and 52 hold for a similarity of 75 % and more; below, windows and the number of bits grow so
that the chances stay below 1e-14.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemill.llm.bits import PACKED, bit_table, count_tables, id_number, in_table, packed
from tidemill.llm.components import components
from tidemill.llm.shared import in_arrow, kept, pick, text_slices
from tidemill.llm.words import mixed, runs

WINDOW = 32
COMMON = 32
COMMON_BITS, CLASS_BITS, SHARED_BITS = 21, 24, 24
SKETCH_DIFFERENCE = 52
SALTS = 16


def _enough(miss: float) -> int:
    """So many shingles, each missing in the other set by the chance ``miss``, are all missing with a chance below 1e-14."""
    return max(WINDOW, math.ceil(32.3 / -math.log(miss))) if miss > 0 else WINDOW


def sketch_difference(percent: int) -> int:
    """More bits than this differ in a pair that links at ``percent`` with a chance below 1e-14: a part's smallest hash is in
    both sets with a chance of at least ``percent`` / 100, else its bits differ half the time."""
    q, tail = (100 - percent) / 200, 0.0
    for bits in range(128, SKETCH_DIFFERENCE, -1):
        tail += math.comb(128, bits) * q**bits * (1 - q) ** (128 - bits)
        if tail >= 1e-14:
            return bits
    return SKETCH_DIFFERENCE


class Sets:
    """Identity, sketch and window of a set of shingle hashes (ascending), at a similarity of ``percent`` / 100."""

    def __init__(self, percent: int, common: np.ndarray | None = None):
        self.percent, self.common = percent, common

    @staticmethod
    def identity(own: np.ndarray) -> bytes:
        return b"".join(int(x).to_bytes(8, "big") for x in (mixed(own, 1).sum(), mixed(own, 2).sum() + np.uint64(len(own))))

    @staticmethod
    def sketch(own: np.ndarray) -> tuple[int, int]:
        part = (mixed(own, 3) & np.uint64(127)).astype(np.int64)
        lowest = np.zeros(128, np.uint64)
        lowest[part[::-1]] = own[::-1]
        halves = np.packbits((mixed(lowest, 4) & np.uint64(1)).astype(np.uint8)).view(">i8")
        return int(halves[0]), int(halves[1])

    def window(self, own: np.ndarray) -> tuple[np.ndarray, int]:
        """(the window, number of uncommon shingles)."""
        n = len(own)
        safe = n - (-(-self.percent * n // 100)) + 1
        if self.common is None:
            miss = (100 - self.percent) / 100
            return own[: min(safe, _enough(miss)) if miss < 1 else safe], n
        common = in_table(self.common, own)
        uncommon = own[~common]
        share = len(uncommon) / n
        miss = (100 - self.percent) / 100 / share if share else 1.0
        if miss < 1:
            safe = min(safe, _enough(miss))
        return np.concatenate([uncommon, own[common]])[:safe], len(uncommon)


def _sets_of(batch: pa.RecordBatch):
    h, first = runs(batch.column(1))
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        yield np.unique(h[begin:end])


_KEYS = pa.list_(pa.int64())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _profiles(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(percent)
        for batch in text_slices(batches, "text"):
            rows = []
            for own in _sets_of(batch):
                rows.append((sets.identity(own), len(own), *sets.sketch(own), _signed(sets.window(own)[0])) if len(own) else (b"", 0, 0, 0, []))
            cid, n, s1, s2, keys = zip(*rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cid, pa.binary()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                                              pa.array(s2, pa.int64()), pa.array(keys, _KEYS)], ["doc_id", "cid", "n", "s1", "s2", "keys"])

    return run


def _chosen(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (number, text) whose number is perhaps wanted; a NULL number always is."""
    for batch in batches:
        numbers = batch.column(0)
        ids = numbers.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        hit = in_table(wanted, ids) | numbers.is_null().to_numpy(zero_copy_only=False)
        if hit.any():
            yield from text_slices([batch.filter(pa.array(hit))], "text")


def _counted(wanted: np.ndarray):
    """How many of the chosen documents hold a shingle, by its low COMMON_BITS bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COMMON_BITS, np.int64)
        for batch in _chosen(batches, wanted):
            for own in _sets_of(batch):
                np.add.at(total, (own & np.uint64(len(total) - 1)).astype(np.int64), 1)
        yield from packed(0, total)

    return run


def _windows(percent: int, wanted: np.ndarray, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(percent, common)
        for batch in _chosen(batches, wanted):
            rows = [(sets.identity(own), *sets.window(own)) for own in _sets_of(batch) if len(own)]
            if rows:
                cid, keys, u = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()), pa.array([_signed(k) for k in keys], _KEYS), pa.array(u, pa.int64())],
                                                 ["cid", "keys", "u"])

    return run


def _members(wanted: np.ndarray, common: np.ndarray):
    """A row for each shingle of a window that is perhaps shared, with the one before it and whether it is common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.asarray(k.values).view(np.uint64) for k in batch.column("keys")]
            keys = [k[in_table(wanted, k)] for k in keys]
            at = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            if len(at):
                before = np.concatenate([np.concatenate([np.zeros(min(len(k), 1), np.uint64), k[:-1]]) for k in keys])
                keys = np.concatenate(keys)
                out = batch.drop_columns(["keys"]).take(pa.array(at))
                for name, column in (("key", _signed(keys)), ("before", _signed(before)), ("common", in_table(common, keys))):
                    out = out.append_column(name, pa.array(column))
                yield out

    return run


def _touched(common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            flat = keys.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            size = keys.value_lengths().to_numpy(zero_copy_only=False)
            hit = np.bincount(np.repeat(np.arange(len(size)), size), weights=in_table(common, flat), minlength=len(size)) > 0
            yield batch.select(["number"]).filter(pa.array(hit))

    return run


def _set_rows(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chosen(batches, wanted):
            rows = [(Sets.identity(own), own.tobytes()) for own in _sets_of(batch) if len(own)]
            if rows:
                cid, own = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()), pa.array(own, pa.binary())], ["cid", "own"])

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (b, salt, the set of b first): shared shingles of b with each a after it."""
    group, pivot = None, np.zeros(0, np.uint64)
    for batch in batches:
        rows = []
        for b, salt, a, own in zip(*(batch.column(c) for c in ("b", "salt", "a", "own"))):
            a, b, own = a.as_py(), b.as_py(), np.frombuffer(own.as_buffer(), np.uint64)
            if a == b:
                group, pivot = (b, salt.as_py()), own
            elif group == (b, salt.as_py()):
                at = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                rows.append((a, b, int((pivot[at] == own).sum()), len(own), len(pivot)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.binary(), *[pa.int64()] * 3))],
                                             ["a", "b", "shared", "n_a", "n_b"])


class JaccardJoin:
    """The join of one table of documents; ``documents`` and ``links`` are its results."""

    def __init__(self, docs: DataFrame, percent: int, doc_id: str, text: str):
        self.percent = percent
        source = pick(docs, doc_id=doc_id, text=text)
        self.id_type: DataType = source.schema["doc_id"].dataType
        self.numbered = source.select(F.when(F.col("doc_id").isNotNull(), id_number(F.col("doc_id"))).alias("number"), "text")
        self.profiles = kept(in_arrow(
            source, _profiles(percent), f"doc_id {self.id_type.simpleString()}, cid binary, n long, s1 long, s2 long, keys array<long>"))
        classes = self.profiles.where("n > 0").groupBy("cid").agg(
            F.min("doc_id").alias("least_id"), *[F.first(c).alias(c) for c in ("n", "s1", "s2", "keys")])
        number = F.when(F.col("least_id").isNotNull(), id_number(F.col("least_id")))
        self.classes = kept(classes.withColumn("number", number))

    # conditions on pairs; x and y are prefixes of columns n, s1, s2, u

    def _near(self, x: str, y: str) -> Column:
        differ = f"(bit_count({x}s1 ^ {y}s1) + bit_count({x}s2 ^ {y}s2))"
        sizes = f"100 * least({x}n, {y}n) >= {self.percent} * greatest({x}n, {y}n)"
        # shingles that only one of two linked sets has: at most (100 - p) / (100 + p) of n_x + n_y
        bound = f"least({sketch_difference(self.percent)}, {100 - self.percent} * ({x}n + {y}n) div {100 + self.percent})"
        # met in a common shingle's region: if they share no uncommon shingle (else they meet in its region too), they share
        # at most the smaller common part, and differ in all that is uncommon
        least = f"least({x}n - {x}u, {y}n - {y}u)"
        most = f"greatest({x}n - {x}u, {y}n - {y}u) + {x}u + {y}u"
        return F.expr(f"{sizes} and {differ} <= {bound} and (not common or 100 * {least} >= {self.percent} * ({most}))")

    def common(self) -> np.ndarray:
        """Bits of the very common shingles. Classes with a shingle in their first windows that is in the windows of more than
        COMMON classes are counted whole, in a table of fixed size; what stands out from its mean by more than COMMON and six
        standard deviations is common. Any choice gives the same links, a good one smaller regions."""
        often = self.classes.select(F.explode("keys").alias("key")).groupBy("key").count().where(F.col("count") > COMMON)
        touched = in_arrow(self.classes.select("number", "keys"), _touched(bit_table(often, "key", 22)), "number long")
        wanted = bit_table(touched, "number", CLASS_BITS)
        counts = count_tables(in_arrow(self.numbered, _counted(wanted), PACKED), 1 << COMMON_BITS).get(0, np.zeros(1 << COMMON_BITS, np.int64))
        bits = counts > counts.mean() + 6 * np.sqrt(counts.mean()) + COMMON
        return np.packbits(bits, bitorder="little").view("<u8")

    def members(self) -> DataFrame:
        """(key, before, common, cid, number, n, s1, s2, u): each class in each region that another class meets too."""
        common = self.common()
        touched = in_arrow(self.classes.select("number", "keys"), _touched(common), "number long")
        wanted = bit_table(touched, "number", CLASS_BITS)
        again = in_arrow(self.numbered, _windows(self.percent, wanted, common), "cid binary, keys array<long>, u long")
        again = again.groupBy("cid").agg(F.first("keys").alias("new"), F.first("u").alias("u"))
        windows = kept(self.classes.join(again, "cid", "left").select(
            "cid", "number", "n", "s1", "s2", F.coalesce("u", "n").alias("u"), F.coalesce("new", "keys").alias("keys")))
        shared = windows.select(F.explode("keys").alias("key")).groupBy("key").count().where("count > 1")
        met = bit_table(shared, "key", SHARED_BITS)
        return in_arrow(windows, _members(met, common), "cid binary, number long, n long, s1 long, s2 long, u long, key long, before long, common boolean")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """(a, b, shared, n_a, n_b) for pairs (a, number_a, b, number_b), b's set read once per salt."""
        pairs = kept(pairs)
        wanted = bit_table(pairs.select(F.col("number_a").alias("x")).union(pairs.select("number_b")), "x", CLASS_BITS)
        sets = in_arrow(self.numbered, _set_rows(wanted), "cid binary, own binary")
        salted = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(SALTS)).alias("salt"))
        asked = salted.union(salted.select(F.col("b").alias("a"), "b", "salt").distinct())
        rows = sets.join(asked, sets["cid"] == asked["a"]).select("b", "salt", "a", "own")
        rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a") != F.col("b"))
        return kept(in_arrow(rows, _compared, "a binary, b binary, shared long, n_a long, n_b long").distinct())

    def _linked(self, compared: DataFrame) -> DataFrame:
        return compared.where(f"100 * shared >= {self.percent} * (n_a + n_b - shared)")

    def links(self) -> DataFrame:
        members = self.members()
        # the class with the smallest share of uncommon shingles lies nearest to the middle of its region
        order = F.struct((F.col("u") / F.col("n")).alias("share"), "cid", "number", "n", "s1", "s2", "u")
        pivots = members.groupBy("key").agg(F.min(order).alias("p"), F.count("*").alias("size")) \
            .where("size > 1").select("key", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("cid", "number", "n", "s1", "s2", "u")])
        met = kept(members.join(pivots, "key"))
        radius = (100 - self.percent) / 100
        stars = met.where("cid <> p_cid").where(self._near("", "p_")).select(
            F.col("cid").alias("a"), F.col("number").alias("number_a"), F.col("p_cid").alias("b"), F.col("p_number").alias("number_b")).distinct()
        stars = self.compared(stars)
        star_links = self._linked(stars)
        # regions again, for classes outside the radius of their pivot
        distance = stars.select(F.col("a").alias("cid"), F.col("b").alias("p_cid"), (1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("d"))
        inside = F.expr(f"coalesce(d <= {radius}, false)")
        placed = kept(met.where("cid <> p_cid").select("key", "before", "common", "cid", "number", "n", "s1", "s2", "u", "p_cid").join(distance, ["cid", "p_cid"], "left")
                      .withColumn("inside", inside))
        fields = ("cid", "number", "n", "s1", "s2", "u", "d", "before")
        left = placed.where("not inside").select("key", *[F.col(c).alias(f"x_{c}") for c in fields])
        right = placed.select("key", "common", "inside", *[F.col(c).alias(f"y_{c}") for c in fields])
        # a pair whose windows have the same shingle before this one meets there too
        once = F.expr("x_cid <> y_cid and (inside or x_cid < y_cid) and (x_before <> y_before or x_before = 0)")
        room = F.expr(f"coalesce(abs(x_d - y_d) <= {radius} + 1e-9, true)")
        x, y = (F.struct(F.col(f"{p}_cid").alias("c"), F.col(f"{p}_number").alias("i")) for p in "xy")
        rest = left.join(right, "key").where(once & room & self._near("x_", "y_")).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        rest = rest.select(F.col("u.c").alias("a"), F.col("u.i").alias("number_a"), F.col("v.c").alias("b"), F.col("v.i").alias("number_b")).distinct()
        return star_links.select("a", "b").union(self._linked(self.compared(rest)).select("a", "b"))

    def documents(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        roots = components(self.links())
        placed = kept(self.classes.select("cid", "least_id").join(roots, F.col("cid") == F.col("node"), "left").select("cid", "least_id", "root"))
        # classes without links are their own component; of the others one component may hold most, so the smallest ids are
        # written before they are joined: AQE splits a hot root only where both sides come straight from a shuffle
        linked = placed.where("root is not null")
        least = kept(linked.groupBy("root").agg(F.min("least_id").alias("component")))
        component = linked.join(least, "root").select("cid", "component").union(placed.where("root is null").select("cid", "least_id"))
        return self.profiles.select("doc_id", "cid", F.col("n").alias("n_shingles")).join(component, "cid", "left").select(
            "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def jaccard_components(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles (its distinct five-word shingles), component_id.

    Documents link when 100 * shared >= ``percent`` * (shingles in either); component_id is the smallest doc_id reachable by
    links. Texts with fewer than five words are one shingle; NULL, empty and wordless texts have none, link to nothing and are
    their own component. Every row gives one row; repeated rows link to each other, rows of one id with different texts are
    documents of their own. A row with NULL as its id takes part; a component of such rows alone has NULL as its id. Texts are
    whole and of any length, an empty table gives no rows, other columns are not read.
    """
    return JaccardJoin(docs, percent, doc_id, text).documents()


def deduplicated(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all columns, one document of each component: the one with the smallest id. Documents without words
    all stay; equal rows (id and text) stay once; rows with NULL ids go where a document with an id is linked to them."""
    found = jaccard_components(docs, percent, doc_id, text)
    stay = found.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct()
    return docs.join(stay, docs[f"`{doc_id}`"].eqNullSafe(stay["_stay"]), "left_semi").dropDuplicates([doc_id, text])
