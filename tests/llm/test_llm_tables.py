"""Files, counts, lines, URLs, mixing and neighbours against brute force, with the odd cases of every column."""

import datetime
import math
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard

from tidemill.llm import line_dedup, mixing, nearest, token_counts, token_files, url_filter
from tidemill.llm.shared import new_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["one two three", "", None, "a <|endoftext|> b", "word " * 30_000, "é\n\n  x", "one two three"]
IDS = [7, 3, 12, None, 5, -2, 7]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def documents(spark, rows=None):
    rows = rows if rows is not None else list(zip(IDS, TEXTS))
    return spark.createDataFrame([(i, t, 1, "v") for i, t in rows], "doc_id long, text string, n_tokens int, value string").repartition(3)


def test_token_counts_of_odd_rows(spark, library):
    got = sorted(map(tuple, token_counts.token_counts(documents(spark), VOCABULARY, limit=5).collect()), key=repr)
    expected = []
    for i, t in zip(IDS, TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 5))
    assert got == sorted(expected, key=repr)
    assert token_counts.token_counts(documents(spark, []), VOCABULARY).count() == 0


def test_token_files_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    path = new_path(spark, "files")
    token_files.write_token_files(documents(spark), path, VOCABULARY, partitions=3)
    order = sorted(zip(IDS, TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for i, t in order:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_files.token_file_digests(spark, path).collect()), key=lambda r: r[1])
    assert got == expected
    read = {r.doc_id: r.ids for r in token_files.read_documents(spark, path, [5, 12, 99]).collect()}
    assert read == {5: library.encode(TEXTS[4], add_special_tokens=False).ids + [2], 12: [2]}
    content = bytearray(max((bytes(r.content) for r in token_files._files(spark, path).collect()), key=len))
    file = token_files.TokenFile(bytes(content))
    whole = b"".join(file.frame(i) for i in range(len(file.frames)))
    assert zstandard.ZstdDecompressor().stream_reader(bytes(content), read_across_frames=True).read() == whole  # any reader can unpack it
    at = struct.calcsize(token_files.TAIL) + struct.calcsize(token_files.FRAME)
    content[-at + 16] ^= 1  # the checksum of the last frame
    with pytest.raises(ValueError):
        token_files.TokenFile(bytes(content)).frame(len(file.frames) - 1)


def test_token_files_of_nothing(spark):
    path = new_path(spark, "files")
    token_files.write_token_files(documents(spark, []), path, VOCABULARY, partitions=2)
    assert token_files.token_file_digests(spark, path).count() == 0


def test_lines_on_many_sites_go(spark):
    rng = random.Random(1)
    pool = [f"line {k} of text" for k in range(30)]
    sites = [f"s{k}" for k in range(12)] + [None]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool[: rng.choice([3, 12, 30])]) + rng.choice(["", "  ", "\r", "\t"]) for _ in range(rng.randint(0, 6))] + [f"own {i}", ""]
        site = sites[min(rng.randrange(13), rng.randrange(13))] if rng.random() < 0.7 else "s0"
        rows.append((i, "\n".join(lines), site))
    rows += [(3, rows[3][1], "s5"), (None, pool[0] + "\nx", "s1"), (400, None, "s1"), (401, "", "s1"), (402, pool[0], "s2"), (403, "long " * 50_000, "s2")]
    spread = {}
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(" \t\r") and s is not None:
                spread.setdefault(line.strip(" \t\r"), set()).add(s)
    bad = {k for k, v in spread.items() if len(v) >= 6}
    assert 2 < len(bad) < 28
    expected = []
    for i, t, _ in rows:
        lines = t.split("\n") if t is not None else []
        stay = [x for x in lines if x.strip(" \t\r") not in bad]
        expected.append((i, sum(bool(x.strip(" \t\r")) for x in lines), len(lines) - len(stay), "\n".join(stay) if t is not None else None))
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, source string, row int, hash string").repartition(4)
    got = line_dedup.without_boilerplate(df, min_sites=6)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert line_dedup.without_boilerplate(df.limit(0)).count() == 0
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def decide(capture, entries):
    page, url, on = capture
    rank = {"block": 1, "drop": 2, "allow": 3}
    history = {}
    for name, pattern, action, listed in entries:
        if None not in (name, pattern, listed) and action in rank:
            key = (name, pattern, listed)
            history[key] = max(history.get(key, 0), rank[action])
    host, _, rest = (url or "").partition("://")[2].partition("/")
    host = host.split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower()
    path = [p for p in rest.split("?")[0].split("#")[0].split("/") if p]
    best, n = None, 0
    for name, pattern in {k[:2] for k in history}:
        before = [(k[2], r) for k, r in history.items() if k[:2] == (name, pattern) and on is not None and k[2] <= on]
        fits = host and (host == pattern or host.endswith("." + pattern) or ("/" in pattern and [host, *path][: pattern.count("/") + 1] == pattern.split("/")))
        if before and fits and max(before)[1] != 2:
            n += 1
            best = max(best or (0,), (len(pattern), max(before)[1] == 3, name, pattern))
    if best is None:
        return (page, url, on, 0, None, None, None, False)
    return (page, url, on, n, best[2], best[3], "allow" if best[1] else "block", not best[1])


def test_captures_against_entries_active_at_fetch_time(spark):
    rng = random.Random(5)
    hosts = ["a.org", "www.a.org", "b.a.org", "c.net", "x.c.net"]
    urls = [f"https://{h}{p}" for h in hosts for p in ("", "/", "/en", "/en/x?q=/de", "/de//y#z")] + ["HTTP://U@WWW.A.org:80/en", "no url", "", None, "https:///x"]
    captures = [(i, rng.choice(urls), day(rng.randrange(300))) for i in range(400)] + [(1, "https://a.org/en", None), (None, "https://a.org/en", day(50)), (7, "https://c.net/" + "p/" * 3000, day(80))]
    patterns = [*hosts, "org", "a.org/en", "www.a.org/en", "c.net/de/y", "x.c.net/en/x"]
    entries = [(rng.choice("pqr"), rng.choice(patterns), rng.choice(["block", "block", "allow", "drop"]), day(rng.randrange(310))) for _ in range(120)]
    entries += [entries[0], ("p", None, "block", day(0)), (None, "a.org", "block", day(0)), ("p", "a.org", "odd", day(0)), ("p", "a.org", "block", None)]
    c = spark.createDataFrame([(*x, "z", 3) for x in captures + captures[:5]], "page_id long, url string, fetched_on date, pattern string, period int")
    e = spark.createDataFrame([(*x, "u") for x in entries], "list string, pattern string, action string, listed_on date, url string")
    got = url_filter.filtered_urls(c, e)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted({decide(x, entries) for x in captures}, key=repr)
    assert url_filter.filtered_urls(c.limit(0), e).count() == 0
    assert url_filter.filtered_urls(c, e.limit(0)).where("blocked").count() == 0


def test_raking_meets_the_margins_within_what_is_there():
    rng = np.random.default_rng(0)
    mass = rng.gamma(0.5, size=(2, 4, 8))
    mass[0, 1] = 0
    margins = [np.array([0.25, 0.75]), np.array([0.5, 0.2, 0.2, 0.1]), np.full(8, 1 / 8)]
    drawn = mixing.raked(mass, margins)
    assert (drawn <= mass + 1e-12).all() and drawn.sum() > 0
    for axis, margin in enumerate(margins):
        assert np.allclose(drawn.sum(axis=tuple(a for a in range(3) if a != axis)) / drawn.sum(), margin, atol=1e-6)
    gone = mixing.raked(np.array([[4.0, 0.0], [6.0, 0.0]]), [np.array([0.5, 0.5]), np.array([0.3, 0.7])])
    assert np.allclose(gone[:, 0], [4, 4], rtol=0.05) and gone[:, 1].sum() == 0
    assert mixing.raked(np.zeros((2, 2)), margins[:2]).sum() == 0


def test_mixing_of_documents(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("alpha bravos charlie deltas echoes foxtrot golfing hotels".split()) for _ in range(rng.randint(1, 30))),
             rng.choice(["s0", "s0", "s1", "s2", None]), rng.choice(["en", "en", "de", "xx", None])) for i in range(3000)]
    rows += [(5, rows[5][1], "s1", "en"), (None, "null id", "s0", "en"), (9001, None, "s0", "de"), (9002, "", None, None), (9003, "long words " * 20_000, "s1", "en")]
    targets = mixing.Targets(source={"s0": 0.3, mixing.OTHER: 0.7}, lang={"en": 0.5, "de": 0.3, "fr": 0.1, mixing.OTHER: 0.1}, topic=0.9)
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "doc_id long, text string, source string, lang string, weight double, n_words int")
    got = mixing.mixed(df, targets).toPandas()
    assert len(got) == len(rows) and got["probability"].between(0, 1 + 1e-9).all()
    mass = got["n_words"] * got["probability"]
    assert math.isclose(mass[got["cell_source"] == "s0"].sum() / mass.sum(), 0.3, abs_tol=1e-4)
    assert math.isclose(mass[got["cell_lang"] == "en"].sum() / mass.sum(), 0.5 / 0.9, abs_tol=1e-4)
    assert abs(got["sampled"].sum() - got["probability"].sum()) < 5 * math.sqrt(len(got)) / 2
    assert got[got["doc_id"] == 5]["sampled"].nunique() <= 2 and got[got["doc_id"].isin([9001, 9002])]["n_words"].eq(0).all()
    stay = mixing.sampled(df, targets)
    assert stay.columns == df.columns
    drawn = set(got[got["sampled"]]["doc_id"].dropna().astype(int))
    assert {r.doc_id for r in stay.select("doc_id").collect() if r.doc_id is not None} == drawn
    assert mixing.mixed(df.limit(0), targets).count() == 0


def exact(rows, k, every):
    best = {}
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for q, a in usable:
        if q % every == 0:
            for i, b in usable:
                if i != q and len(a) == len(b):
                    score = float(nearest.cosines(a[None], b[None])[0])
                    best.setdefault(q, {})[i] = max(score, best.get(q, {}).get(i, -2))
    return {q: sorted(((-s, i) for i, s in found.items()))[:k] for q, found in best.items()}


def test_nearest_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(60, 130)]  # many equal ones
    rows += [(140, None), (150, []), (160, [0.0] * 4), (170, [1.0, None, 0.0, 0.0]), (180, [float("nan")] * 4), (190, [float("inf"), 1.0, 1.0, 1.0]),
             (None, [1.0] * 4), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (202, [-1.0, 5.0]), (210, [7.0] * 3), (10, rows[10][1]), (20, [1e300, 1e300, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "b") for i, v in rows], "vec_id long, embedding array<double>, length int, bucket string")
    got = nearest.nearest(df, k=5, every=10).collect()
    expected = exact(rows, 5, 10)
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by_query) == {q for q, e in expected.items() if e}
    for q, e in expected.items():
        assert [i for _, i, _ in by_query[q]] == [i for _, i in e]
        assert np.allclose([s for _, _, s in by_query[q]], [-s for s, _ in e], atol=1e-12)
    assert nearest.nearest(df.limit(0)).count() == 0


def test_nearest_finds_nine_of_ten(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SPLIT", 100)
    monkeypatch.setattr(nearest, "BUCKET", 20)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    v = centres[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    v = v.astype(np.float32).astype(float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    found = {}
    for r in nearest.nearest(df).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    near = u[::50] @ u.T
    near[np.arange(60), np.arange(0, 3000, 50)] = -2
    true = np.argsort(-near, axis=1)[:, :5]
    assert sum(len(found[50 * q] & set(t.tolist())) for q, t in enumerate(true)) >= 0.9 * true.size
    hashing = nearest.fitted(16, 3000, v, 5)
    assert hashing.m >= 3 and hashing.probes < 7**hashing.m
