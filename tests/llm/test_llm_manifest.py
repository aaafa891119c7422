"""The Merkle manifest against a tree built in memory: any number of rows, small blocks, odd rows, versions."""

import hashlib
import zlib

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemill.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, add=0):
    i, source, lang, n, text = row
    return h(*map(field, (i, source, lang, n if n is None else n + add, text)))


def tree(nodes):
    """Levels from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def proof(levels, at):
    found = []
    for row in levels[:-1]:
        found.append(row[at ^ 1] if at ^ 1 < len(row) else "")
        at >>= 1
    return found


def fold(node, levels, at):
    copies = [node]
    for s in proof(levels, at):
        node = h(s, node) if at % 2 else h(node, s)
        copies.append(node)
        at >>= 1
    return copies


def tampered(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 0


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), leaf(r, tampered(r[0])), r))
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: tree([x[2] for x in sorted(by[v])]) for v in langs}
    top = tree([trees[v][-1][0] for v in langs])
    out, copied = [], []
    for k, v in enumerate(langs):
        for at, (_, _, node, other, r) in enumerate(sorted(by[v])):
            low = fold(other, trees[v], at)
            high = fold(low[-1], top, k)
            way = [s for s in proof(trees[v], at) + proof(top, k) if s]
            out.append((r[0], node, trees[v][-1][0], top[-1][0], way, high[-1], high[-1] == top[-1][0]))
            if other != node:
                copied += [(r[0], level, n) for level, n in enumerate(low + high[1:])]
    return sorted(out, key=repr), sorted(copied, key=repr)


def documents(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, key int, place string"
    return spark.createDataFrame([(*r, 1, "p") for r in rows], schema).repartition(5)


def changed():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 0


def rows_of(n, langs):
    return [(i * 7 - 30, f"s{i % 3}" if i % 11 else None, langs[i % len(langs)], i if i % 5 else None, ["", None, f"text é {i}"][i % 3]) for i in range(n)]


@pytest.fixture
def sent_whole():
    """Workers get the module as it is here, a changed BITS included."""
    cloudpickle.register_pickle_by_value(manifest)
    yield
    cloudpickle.unregister_pickle_by_value(manifest)


@pytest.mark.parametrize("n, bits", [(1, 1), (9, 1), (64, 2), (65, 2), (150, 3), (700, 10)])
def test_equals_a_tree_in_memory(spark, monkeypatch, sent_whole, n, bits):
    monkeypatch.setattr(manifest, "BITS", bits)
    rows = rows_of(n, ["en", "en", "en", None, "de", "é", "en"])
    expected, copied = brute(rows)
    got = manifest.manifest(documents(spark, rows), changed())
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert sorted(map(tuple, manifest.copied_nodes(documents(spark, rows), changed()).collect()), key=repr) == copied


def test_many_keys(spark):
    rows = rows_of(120, [f"l{i}" for i in range(40)])
    assert sorted(map(tuple, manifest.manifest(documents(spark, rows), changed()).collect()), key=repr) == brute(rows)[0]


def test_repeated_rows_and_ids(spark):
    rows = rows_of(20, ["en", "de"]) + [(5, "s", "en", 1, "same")] * 60 + [(5, "s", "en", n, "other") for n in range(4)] + [(None, "s", "en", 3, "none")] * 2
    got = sorted(map(tuple, manifest.manifest(documents(spark, rows), changed()).collect()), key=repr)
    assert got == brute(rows)[0]


def test_null_counts_cannot_be_tampered_with(spark):
    ids = [i for i in range(200) if tampered(i)][:4]
    got = {r["doc_id"]: r["verified"] for r in manifest.manifest(documents(spark, [(i, "s", "en", None if k % 2 else 5, "t") for k, i in enumerate(ids)]), changed()).collect()}
    assert got == {i: bool(k % 2) for k, i in enumerate(ids)}


def test_empty_table(spark):
    assert manifest.manifest(documents(spark, []), changed()).count() == 0
