"""The registered queries ``opN_<name>``: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (decontamination, fingerprints, jaccard, line_dedup, manifest, mixing, nearest, quality, resampling, token_counts, token_files, toxicity,
                          url_filter)
from tidemill.llm.shared import new_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
MIN_SITES = 8


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# Words as in ``words``: A-Z lower-cased, split at the space and 0x09-0x0D; SHINGLES needs ``t`` (id, text).
WORDS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x20\x09-\x0D]+')")


def shingles_sql(name: str, source: str, key: str) -> str:
    return f"""
{name}_words AS (SELECT {key}, {WORDS_SQL} AS w FROM {source}),
{name} AS (SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM {name}_words WHERE len(w) > 0))"""


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query(f"""
WITH {shingles_sql("d", "documents", "doc_id")}, {shingles_sql("b", "benchmark", "item_id")},
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
SELECT doc_id, item_id, max(n) AS n_shingles, count(*) AS n_shared, count(*) / max(n)::DOUBLE AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING 4 * count(*) >= 3 * max(n)
""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(f"""
WITH lines AS (SELECT doc_id, source, line, pos, trim(line, chr(32) || chr(9) || chr(13)) AS bare FROM
    (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents)),
bad AS (SELECT bare FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT l.*, b.bare IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON l.bare = b.bare)
SELECT doc_id, CAST(count(*) FILTER (bare <> '') AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_boilerplate(table(spark, sf_dir, "documents"), MIN_SITES)


@query()
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


@query(f"""
WITH RECURSIVE {shingles_sql("d", "documents", "doc_id")},
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM d x JOIN d y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 75 * (na.n + nb.n - k)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
""")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


# Captures and list entries made from the table ``pages``: a page's fetch day from its id; changes of four lists from the
# hosts, their domains and first path parts, by the remainder of a number made from their MD5.
CHANGES = [  # list, kind of pattern, modulus, remainder, action, day of the year
    ("spam", "host", 3, 0, "block", 20), ("spam", "host", 6, 0, "drop", 140), ("spam", "host", 12, 0, "block", 230),
    ("adult", "host", 5, 1, "block", 75), ("adult", "host", 5, 1, "allow", 300), ("malware", "domain", 2, 1, "block", 180),
    ("malware", "domain", 4, 1, "drop", 210), ("trusted", "path", 4, 2, "allow", 0), ("trusted", "path", 8, 2, "drop", 250),
    ("spam", "path", 7, 3, "block", 100),
]


def captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    captures = pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(page_id * 37 % 366 as int))").alias("fetched_on"))
    host = url_filter.host_of(F.col("url"))
    named = pages.where("url is not null").select(host.alias("host"), F.get(F.split(url_filter.path_of(F.col("url")), "/"), F.lit(1)).alias("part"))
    kinds = {"host": F.col("host"), "domain": F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "path": F.concat("host", F.lit("/"), "part")}
    patterns = named.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), p.alias("pattern")) for k, p in kinds.items()])).alias("p")) \
        .select("p.*").where("length(pattern) > 0").distinct()
    changes = F.array(*[F.struct(F.lit(name).alias("list"), F.lit(kind).alias("of"), F.lit(m).alias("m"), F.lit(r).alias("r"), F.lit(action).alias("action"), F.lit(day).alias("day"))
                        for name, kind, m, r, action, day in CHANGES])
    entries = patterns.select("kind", "pattern", F.conv(F.substring(F.md5("pattern"), 1, 7), 16, 10).cast("long").alias("x"), F.explode(changes).alias("c")).where("c.of = kind and x % c.m = c.r") \
        .select("c.list", "pattern", "c.action", F.expr("date_add(date'2024-01-01', cast(c.day + x % 50 as int))").alias("listed_on"))
    return captures, entries


_HOST_SQL = r"""lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1))"""
_PATH_SQL = r"""regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"""


@query(rf"""
WITH captures AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched_on, {_HOST_SQL} AS host, {_PATH_SQL} AS path FROM pages),
patterns AS (
    SELECT 'host' AS kind, host AS pattern FROM captures UNION
    SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM captures UNION
    SELECT 'path', host || '/' || split_part(path, '/', 2) FROM captures WHERE path LIKE '/%'),
changes(list, kind, m, r, action, day) AS (VALUES {", ".join(str(c) for c in CHANGES)}),
entries AS (SELECT list, pattern, action, DATE '2024-01-01' + CAST(day + x % 50 AS INTEGER) AS listed_on
    FROM (SELECT *, CAST('0x' || substr(md5(pattern), 1, 7) AS BIGINT) AS x FROM patterns WHERE length(pattern) > 0) p JOIN changes USING (kind) WHERE x % m = r),
days AS (SELECT list, pattern, listed_on, max(CASE action WHEN 'block' THEN 1 WHEN 'drop' THEN 2 ELSE 3 END) AS rank FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(listed_on) OVER (PARTITION BY list, pattern ORDER BY listed_on) AS next FROM days),
met AS (SELECT page_id, url, fetched_on, list, pattern, CASE rank WHEN 1 THEN 'block' ELSE 'allow' END AS action,
    row_number() OVER (PARTITION BY page_id, url, fetched_on ORDER BY length(pattern) DESC, rank DESC, list DESC, pattern DESC) AS place, count(*) OVER (PARTITION BY page_id, url, fetched_on) AS n
    FROM captures c JOIN spans s ON rank <> 2 AND fetched_on >= listed_on AND (next IS NULL OR fetched_on < next)
    AND (host = pattern OR host LIKE '%.' || pattern OR starts_with(host || regexp_replace(path, '/+$', '') || '/', pattern || '/')))
SELECT c.page_id, c.url, strftime(c.fetched_on, '%Y-%m-%d') AS fetched_on, coalesce(n, 0) AS n_active, list, pattern, action, coalesce(action = 'block', false) AS blocked
FROM captures c LEFT JOIN met m ON place = 1 AND c.page_id = m.page_id AND c.url = m.url AND c.fetched_on = m.fetched_on
""")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_entries(table(spark, sf_dir, "pages"))
    found = url_filter.filtered_urls(captures, entries)
    return found.withColumn("fetched_on", F.date_format("fetched_on", "yyyy-MM-dd"))


TARGETS = mixing.Targets(source={"src0": 0.25, mixing.OTHER: 0.75}, lang={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.14, mixing.OTHER: 0.01}, topic=0.7)


@query()
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), TARGETS)


@query()
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary_path(), END_ID)
    return token_files.token_file_digests(spark, path)


@query()
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.beside_next(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprints.as_text(F.col("fingerprint")).alias("fingerprint"),
                        fingerprints.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def crc32_sql(text: str) -> str:
    """crc32 of a text's UTF-8 bytes; needs ``crc`` (t: the table of 256 remainders)."""
    bytes_ = f"list_transform(range(length(hex(encode({text}))) // 2), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce([4294967295] || {bytes_}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"


CRC_SQL = """crc AS (SELECT list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i))"""

BUCKETS, PERCENT, MIN_WORDS, SEED = 10_000, 10, 20, 2024
_FEATURES = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query(f"""
WITH {CRC_SQL},
d AS (SELECT row_number() OVER () AS r, doc_id, {_FEATURES} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS w FROM d), bw AS (SELECT unnest({_FEATURES}) AS w FROM benchmark),
bucket AS (SELECT w, {crc32_sql("w")} % {BUCKETS} AS k FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT k, count(*) AS s FROM dw JOIN bucket USING (w) GROUP BY k), t AS (SELECT k, count(*) AS t FROM bw JOIN bucket USING (w) GROUP BY k),
gain AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + {BUCKETS})::DOUBLE))) AS BIGINT) AS g FROM s LEFT JOIN t USING (k)),
weights AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM dw JOIN bucket USING (w) JOIN gain USING (k) GROUP BY r),
scored AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (r)),
placed AS (SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * (SELECT count(place) FROM placed) // 100 THEN place END AS rank FROM placed
""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), PERCENT, MIN_WORDS, BUCKETS, 1, SEED)


def _field_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# A tree in SQL: the nodes of each level from those below, then every row's way up, one level at a time.
@query(f"""
WITH RECURSIVE {CRC_SQL},
leaves AS (SELECT row_number() OVER (ORDER BY doc_id, leaf) AS r, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} END AS tampered FROM documents, crc)),
nodes AS (SELECT lang, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM leaves
    UNION ALL SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((n + 1) // 2) FROM nodes WHERE n > 1 GROUP BY lang, level, place // 2),
subroots AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, place, subroot AS node, count(*) OVER () AS n FROM subroots
    UNION ALL SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((n + 1) // 2) FROM tops WHERE n > 1 GROUP BY level, place // 2),
way AS (SELECT r, lang, 0 AS level, place, coalesce(tampered, leaf) AS node, '' AS proof FROM leaves
    UNION ALL SELECT r, w.lang, w.level + 1, w.place // 2, sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(s.node, '') || w.node ELSE w.node || coalesce(s.node, '') END), w.proof || coalesce(s.node, '')
    FROM way w JOIN nodes own ON own.lang IS NOT DISTINCT FROM w.lang AND own.level = w.level AND own.place = w.place AND own.n > 1
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.place = xor(w.place, 1)),
low AS (SELECT w.r, w.lang, w.node, w.proof FROM way w JOIN nodes own ON own.lang IS NOT DISTINCT FROM w.lang AND own.level = w.level AND own.place = w.place AND own.n = 1),
high AS (SELECT r, 0 AS level, s.place, node, proof FROM low JOIN subroots s ON s.lang IS NOT DISTINCT FROM low.lang
    UNION ALL SELECT r, w.level + 1, w.place // 2, sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(s.node, '') || w.node ELSE w.node || coalesce(s.node, '') END), w.proof || coalesce(s.node, '')
    FROM high w JOIN tops own ON own.level = w.level AND own.place = w.place AND own.n > 1 LEFT JOIN tops s ON s.level = w.level AND s.place = xor(w.place, 1)),
ends AS (SELECT w.r, w.node AS folded_root, sha256(w.proof) AS proof_sha256 FROM high w JOIN tops own ON own.level = w.level AND own.place = w.place AND own.n = 1)
SELECT doc_id, leaf, subroot, t.node AS root, proof_sha256, folded_root, folded_root = t.node AS verified
FROM leaves l JOIN ends USING (r) JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang JOIN tops t ON t.n = 1
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = manifest.manifest(table(spark, sf_dir, "documents"), changed)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified")
