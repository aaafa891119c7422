"""One-permutation MinHash fingerprints, with DataFrame functions only.

1. Every distinct run of five words is hashed once. The hash's first eight bits name one of 256 bins, and a bin keeps its least hash.
2. Empty bins are filled by optimal densification: an empty bin tries the bins that its own sequence of hashes names, the same
   sequence in every document, and takes the first that is not empty. After TRIES the sequence goes on as an order of all bins, so
   that it ends for any document.
3. Of each bin the low BITS bits are kept, packed into 64-bit numbers: 128 bytes a document.
4. Two bins agree by chance in one of 2**BITS cases; the share of equal bins is corrected for that.

A word is a run of bytes other than the space and 0x09-0x0D, with A-Z lower-cased. Fewer than five words are one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import kept, pick

WIDTH = 5
LOG_BINS = 8
BINS = 1 << LOG_BINS
BITS = 4
TRIES = 8
PER_NUMBER = 64 // BITS
SEED = 71

BLANKS = r"[\x20\x09-\x0D]+"


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, BLANKS), "")


def _runs(words: Column) -> Column:
    """Hash of every run of WIDTH words; of the whole where there are fewer; none without words."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))
    return F.when(F.size(words) >= WIDTH, each).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))


def _bin(h: Column) -> Column:
    return F.shiftright(h, 64 - LOG_BINS).cast("int") + BINS // 2


def _least(hashes: Column) -> Column:
    """The least hash of each bin that has one, bins ascending: the first of its bin among the sorted hashes."""
    return once(F.sort_array(hashes), lambda s: F.filter(s, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(s, i - 1)))))


def _slots(least: Column) -> Column:
    """One entry a bin, NULL where it is empty."""
    none = F.lit(None).cast("bigint")
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(least, i - 1)))
    filled = F.flatten(F.transform(least, lambda h, i: F.concat(F.array_repeat(none, _bin(h) - before(i) - 1), F.array(h))))
    return F.concat(filled, F.array_repeat(none, BINS - 1 - _bin(F.element_at(least, -1))))


def _filled(slots: Column, least: Column) -> Column:
    """Low bits of every bin, empty ones filled from others."""
    def value(i: Column) -> Column:
        tries = [F.get(slots, F.pmod(F.hash(i, F.lit(SEED + t)), F.lit(BINS))) for t in range(TRIES)]
        # the least of the full bins in the order that belongs to bin i
        last = F.array_min(F.transform(least, lambda h: F.struct(F.xxhash64(i, _bin(h)), h.alias("h"))))["h"]
        return F.coalesce(F.get(slots, i), *tries, last).bitwiseAND(F.lit((1 << BITS) - 1))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)


def _packed(codes: Column) -> Column:
    """PER_NUMBER codes to a number, the first in its highest bits."""
    def number(k: Column) -> Column:
        return F.aggregate(F.slice(codes, k * PER_NUMBER + 1, F.lit(PER_NUMBER)), F.lit(0).cast("bigint"), lambda sofar, c: F.shiftleft(sofar, BITS).bitwiseOR(c))

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_NUMBER - 1)), number)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint, array<bigint>; empty for a text without words or NULL. Equal texts have equal fingerprints."""
    least = once(_words(text), lambda w: once(_runs(w), _least))
    packed = once(least, lambda m: F.when(F.size(m) > 0, once(_slots(m), lambda s: once(_filled(s, m), _packed))))
    return F.coalesce(packed, F.array().cast("array<bigint>"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' runs, 0 to 1, corrected for bins that agree by chance. Two texts without
    words are equal (1); one alone is like nothing (0)."""
    ones = int("1".rjust(BITS, "0") * PER_NUMBER, 2)

    def different(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for half in (2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, half))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    apart = F.aggregate(F.zip_with(a, b, different), F.lit(0), lambda n, d: n + d)
    chance = 2.0**-BITS
    raw = (1 - apart.cast("double") / BINS - chance) / (1 - chance)
    return F.when(F.size(a) != F.size(b), F.lit(0.0)).when(F.size(a) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), raw))


def as_text(packed: Column) -> Column:
    """Sixteen hex digits a number."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (array of 64-bit numbers).

    A NULL or empty text, or one of blanks alone, has an empty fingerprint. Every row gives one row, repeated rows equal ones; ids
    may be NULL or repeated. Very long texts are one array of hashes at a time. An empty table gives no rows; columns not named are not
    read, so their names cannot clash.
    """
    return pick(docs, doc_id=doc_id, text=text).select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


# --- each document beside the next ---------------------------------------------------------------------------------

#: Text of a range: each is sorted in one task, and spills where it must. At most MOST_RANGES first rows are broadcast.
RANGE_BYTES = 8 << 20
MOST_RANGES = 1 << 16


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``, by halving: a step for each power of two."""
    table = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")

    def after(step: int):
        return lambda at: F.when(F.get(table, at + step - 1) <= value, at + step).otherwise(at)

    found = F.lit(0)
    for power in reversed(range(len(cuts).bit_length())):
        found = once(found, after(1 << power))
    return found


def with_next(rows: DataFrame, text: str, add: dict[str, Column]) -> DataFrame:
    """``rows`` (a whole number ``doc_id`` and ``text``) with the columns of ``add``, and ``next_<column>`` for these and the text:
    those of the row that follows in order of doc_id (NULL first; rows of one id by the hash of their text), after the last
    those of the first.

    Ids are cut into ranges of about RANGE_BYTES of text, at quantiles, and each range is sorted by itself. The first row of
    every range is sent along with the range before it, so the rows are shuffled once. Rows of one id lie in one range.
    """
    columns = [*add, text]
    count, total = rows.agg(F.count("*"), F.sum(F.octet_length(text).cast("long"))).first()
    ranges = min(MOST_RANGES, max(8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total or 0) // RANGE_BYTES))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 4 * ranges)).first()[0] if count else None
    keyed = rows.withColumns({"_range": F.coalesce(_range_of(F.col("doc_id"), sorted(set(cuts))), F.lit(0)) if cuts else F.lit(0), "_tie": F.xxhash64(text)})
    # a range's first row, and the range before it that has rows (of the first: the last)
    firsts = kept(keyed.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "_tie")).alias("first")))
    in_order = Window.orderBy("_range")
    before = F.coalesce(F.lag("_range").over(in_order), F.last("_range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = F.broadcast(kept(firsts.select(F.col("first.doc_id").alias("_id"), F.col("first._tie").alias("_of"), F.col("_range").alias("_own"), before.alias("_before"))))
    met = keyed.join(heads, keyed["doc_id"].eqNullSafe(heads["_id"]) & (keyed["_tie"] == heads["_of"]) & (keyed["_range"] == heads["_own"]))
    copies = met.dropDuplicates(["_own"]).select(*rows.columns, F.col("_before").alias("_range"), "_tie", F.lit(True).alias("_copy"))
    both = keyed.withColumn("_copy", F.lit(False)).unionByName(copies).withColumns(add)
    follows = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").asc_nulls_first(), "_tie")
    return both.withColumns({f"next_{c}": F.lead(c).over(follows) for c in columns}).where(~F.col("_copy")).drop("_copy", "_tie", "_range")


def beside_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited (the text whose last floor(n_chars / 2) characters give way to the first as many, or
    all, of the next document's), fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next id, NULL ids first, after the last the first; a single document follows itself. Rows
    of one id are ordered by a hash of their text, equal rows follow one another; ids are whole numbers. A NULL text is an empty one. Cases of fingerprints
    as in ``fingerprints``; an empty table gives no rows.
    """
    source = pick(docs, doc_id=doc_id, text=text).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(source, "text", {"fingerprint": fingerprint(F.col("text"))})
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("next_text", F.lit(1), half))
    made = paired.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    both = made.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return both.select("doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
