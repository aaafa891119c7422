"""One-permutation MinHash against a brute-force version, and the order of documents."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import fingerprints as fp

MASK = 2**64 - 1
BLANKS = [chr(32), *map(chr, range(9, 14))]


def signed(x, bits=64):
    return x - (1 << bits) if x >= 1 << (bits - 1) else x


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for b in BLANKS:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def chained(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64(p.encode(), seed=seed).intdigest()
    return seed


def murmur(numbers, seed=42):
    """The engine's 32-bit hash of whole numbers."""
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF
    h = seed
    for n in numbers:
        k = rot((n & 0xFFFFFFFF) * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h ^= 4
        h = (h ^ (h >> 16)) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ (h >> 13)) * 0xC2B2AE35 & 0xFFFFFFFF
        h ^= h >> 16
    return signed(h, 32)


def order_of(i, b):
    seed = 42
    for n in (i, b):
        seed = xxhash_int(n, seed)
    return signed(seed)


def xxhash_int(n, seed):
    p1, p2, p3, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & MASK
    h = (seed + p5 + 4) & MASK
    h ^= (n & 0xFFFFFFFF) * p1 & MASK
    h = (rot(h, 23) * p2 + p3) & MASK
    h = (h ^ (h >> 33)) * p2 & MASK
    h = (h ^ (h >> 29)) * p3 & MASK
    return h ^ (h >> 32)


def brute(text):
    w = words_of(text)
    runs = [chained(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [chained([" ".join(w)])] if w else []
    bins = {}
    for h in map(signed, runs):
        b = (h >> 56) + 128
        bins[b] = min(bins.get(b, h), h)
    if not bins:
        return ""
    codes = []
    for i in range(fp.BINS):
        tries = [i, *[murmur([i, fp.SEED + t]) % fp.BINS for t in range(fp.TRIES)]]
        full = next((b for b in tries if b in bins), None)
        if full is None:
            full = min(bins, key=lambda b: order_of(i, b))
        codes.append(bins[full] & 15)
    return "".join(f"{c:x}" for c in codes)


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (words_of(a), words_of(b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def prose(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(5)
    texts = ["", None, " \t\n", "One two", "one TWO", "a b c d e", "ä ö ü ß é", " x y z v w", "the same " * 40, prose(rng, 30), prose(rng, 300), prose(rng, 5_000), prose(rng, 60_000)]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint int").repartition(3)
    got = dict(fp.fingerprints(df).select("doc_id", fp.as_text(F.col("fingerprint"))).collect())
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[3] == got[4] and len(got[5]) == 256 and got[0] == got[1] == got[2] == ""


@pytest.mark.parametrize("size", [40, 200, 2_000])
def test_likeness_is_near_jaccard(spark, size):
    rng, pairs = random.Random(size), []
    for share in (0, 0.1, 0.3, 0.6, 0.9, 1):
        for _ in range(20):
            a = prose(rng, size).split()
            cut = round(size * share)
            pairs.append((" ".join(a), " ".join(a[:cut] + prose(rng, size - cut).split()) if cut < size else " ".join(a)))
    df = spark.createDataFrame(pairs, "a string, b string")
    found = [r[0] for r in df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))).collect()]
    errors = [f - jaccard(a, b) for f, (a, b) in zip(found, pairs)]
    assert all(0 <= f <= 1 for f in found) and found[-20:] == [1.0] * 20
    # a bin's chance error is at most a half, and few runs fill few bins of their own
    deviation = 0.5 / min(fp.BINS, size * 0.6) ** 0.5 * 16 / 15
    assert max(map(abs, errors)) < 4.5 * deviation
    assert abs(sum(errors) / len(errors)) < 0.02 + deviation / 5


def edited(text, follower):
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def test_each_document_beside_the_next(spark):
    rng = random.Random(9)
    rows = [(i * 3 - 50, prose(rng, rng.randrange(0, 60)), "x") for i in range(300)]
    rows += [(None, "no id here at all", "x"), (2**60, "é" * 7 + " 𝄞𝄞 far away", "x"), (1_000, None, "x"), (1_001, "", "x"), (1_002, "tail end of it all", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, next_text string").repartition(7)
    got = {r["doc_id"]: r for r in fp.beside_next(df).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    assert len(got) == len(rows)
    for (i, text, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", got[i]
        assert (r["n_chars"], r["edited"]) == (len(text), edited(text, after))
        assert (not r["fingerprint"]) == (not words_of(text)) and 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if text == after:
            assert r["near_next"] == 1


def test_repeated_ids_single_rows_and_none(spark):
    schema = "doc_id long, text string"
    one = fp.beside_next(spark.createDataFrame([(4, "abcd")], schema)).first()
    assert (one["edited"], one["near_next"]) == ("abab", 1.0)
    assert fp.beside_next(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(2, "g h i j k")] * 4 + [(None, None)] * 3, schema).repartition(4)
    got = sorted((r["doc_id"] or 0, r["edited"]) for r in fp.beside_next(same).collect())
    assert got == sorted([(0, "")] * 3 + [(1, edited("a b c d e f", "a b c d e f"))] * 4 + [(1, edited("a b c d e f", "g h i j k"))]
                         + [(2, edited("g h i j k", "g h i j k"))] * 3 + [(2, edited("g h i j k", ""))])


def test_digests_of_the_query(spark):
    import __spark_entry__ as entry

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in entry.queries()["op11_fingerprints"](spark, "/root/testdata/sf0.001").collect()}
    for a, b in zip(docs, docs[1:] + docs[:1]):
        r, e = got[a["doc_id"]], edited(a["text"] or "", b["text"] or "")
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (brute(a["text"]), brute(e))
        assert abs(r["near_edited"] - jaccard(a["text"], e)) < 0.3
