"""Joins against brute force, with the odd cases of every column."""

import random

import pytest

from tidemill.llm import decontamination, jaccard, words
from tidemill.llm.components import components

DOCS = "doc_id long, text string, key string, n long, cid string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "k", 7, "c") for i, t in rows], DOCS).repartition(3)


def brute(rows):
    sets = [words.shingle_texts(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for x in range(len(rows)):
        if rows[x][0] is not None:
            least[find(x)] = min(least.get(find(x), rows[x][0]), rows[x][0])
    return sorted(((rows[x][0], len(sets[x]), least.get(find(x)) if sets[x] else rows[x][0]) for x in range(len(rows))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def words_of(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randint(0, 300)) for _ in range(n)]


def test_groups_of_near_copies_and_shared_passages(spark):
    rng = random.Random(3)
    shared = [words_of(rng, 60) for _ in range(2)]
    texts = []
    for length, copies in ((150, 70), (30, 40), (8, 20), (5, 6), (3, 4), (600, 5)):
        base = words_of(rng, length)
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
                w[rng.randrange(len(w))] = rng.choice(words_of(rng, 1))
            texts.append(" ".join(w + (rng.choice(shared) if rng.random() < 0.3 else [])))
    texts += [" ".join(words_of(rng, rng.randint(10, 60)) + rng.choice(shared)) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert found(jaccard.jaccard_components(frame(spark, rows))) == brute(rows)


def test_odd_rows_of_the_jaccard_join(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(4, text), (9, text.upper()), (9, text), (4, text), (None, text + " x"), (None, "alone with a null id here"), (1, None), (2, ""), (3, " \n"),
            (5, "two words"), (6, "Two\tWORDS"), (7, "two word"), (8, "w " * 3000), (10, "w w w w w")]
    got = jaccard.jaccard_components(frame(spark, rows))
    assert found(got) == brute(rows)
    assert jaccard.jaccard_components(frame(spark, rows).limit(0)).count() == 0


def test_one_document_of_each_component_stays(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(4, text), (9, text + " x"), (4, text), (1, None), (2, ""), (None, text), (None, "alone with a null id here"), (30, "other text of just six words")]
    stay = jaccard.deduplicated(frame(spark, rows))
    assert stay.columns == ["doc_id", "text", "key", "n", "cid"]
    assert sorted(r.doc_id for r in stay.where("doc_id is not null").collect()) == [1, 2, 4, 30]


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(120)], [(0, i) for i in range(1, 90)], [], [(3, 3), (5, 4), (4, 5)]])
def test_components(spark, links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in root}


def contained(docs, items, share=0.75):
    out = []
    for i, t in docs:
        own = words.shingle_texts(t or "")
        for k, x in dict.fromkeys(items):
            item = words.shingle_texts(x or "")
            both = len(own & item)
            if item and both >= share * len(item):
                out.append((i, k, len(item), both))
    return sorted(out, key=repr)


def test_items_inside_documents(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, " ".join(words_of(rng, rng.choice([3, 5, 6, 9, 17, 33, 60])))) for k in range(40)]
    items += [(40, items[0][1]), (41, items[5][1]), (41, items[5][1]), (41, items[6][1]), (42, None), (43, ""), (None, items[7][1])]
    docs = []
    for i in range(120):
        w = words_of(rng, rng.choice([0, 4, 30, 400]))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items[:40])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((i, " ".join(w)))
    docs += [(5, docs[5][1]), (None, items[9][1]), (200, None), (201, ""), (202, items[0][1].upper()), (203, "x " * 20_000 + items[20][1])]
    df, listed = frame(spark, docs), spark.createDataFrame([(k, x, "own") for k, x in items], "item_id long, text string, doc_id string")
    expected = contained(docs, items)
    assert len(expected) > 60
    for size in (8_000_000, 1_500):  # one block of items, several
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
        got = decontamination.contained_items(df, listed).select("doc_id", "item_id", "n_shingles", "n_shared")
        assert sorted(map(tuple, got.collect()), key=repr) == expected
    left = decontamination.decontaminated(df, listed)
    assert left.columns == df.columns
    hit = {i for i, *_ in expected}
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(i) for i, _ in docs if i not in hit)
    assert decontamination.contained_items(df.limit(0), listed).count() == 0
    assert decontamination.contained_items(df, listed.limit(0)).count() == 0
