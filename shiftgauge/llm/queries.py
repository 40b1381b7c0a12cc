"""The operators as queries on the driver's tables, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiftgauge.checkpoints import scratch_path
from shiftgauge.llm import (
    centroids,
    collocations,
    decontaminate,
    jaccard,
    language_id,
    license_scan,
    one_permutation,
    packing,
    personal_data,
    search,
    secret_scan,
    token_files,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(_table(spark, sf_dir, "documents"))


def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(_table(spark, sf_dir, "documents"))


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_digest(_table(spark, sf_dir, "documents"))


def _personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_digest(_table(spark, sf_dir, "documents"))


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_digest(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.duplicate_digest(_table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.every_50th(_table(spark, sf_dir, "documents"))


def _packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).drop("row")


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark)}/tokens"
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_files.token_index(spark, path)


def _collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def _centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_digest(_table(spark, sf_dir, "embeddings"))


def _one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.component_digest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": _licenses,
        "op2_secret_scan": _secrets,
        "op3_language_id": _language,
        "op4_personal_data": _personal_data,
        "op5_benchmark_decontamination": _decontamination,
        "op6_ngram_jaccard_join": _near_duplicates,
        "op7_toxicity": _toxicity,
        "op8_exact_search": _search,
        "op9_best_fit_packing": _packing,
        "op10_token_files": _token_files,
        "op11_phrase_collocations": _collocations,
        "op12_centroid_clustering": _centroids,
        "op13_minhash_near_dedup": _one_permutation,
    }


_WORDS_SQL = """string_split(trim(regexp_replace(
    translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' ')"""

_DECONTAMINATION_SQL = f"""
    WITH d AS (SELECT doc_id, list_filter({_WORDS_SQL.format("text")}, lambda x: x <> '') AS w
               FROM documents),
    b AS (SELECT item_id, list_filter({_WORDS_SQL.format("text")}, lambda x: x <> '') AS w
          FROM benchmark),
    iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
                  array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS run
           FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b
                 WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM iw),
    dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS run
           FROM (SELECT d.*, n, unnest(range(1, len(w) - n + 2)) AS i
                 FROM d, sizes WHERE len(w) >= n)),
    hits AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN iw USING (run) WHERE dw.n = iw.n),
    covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits),
    h AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
    ids AS (SELECT doc_id, count(*) AS n_items,
                   string_agg(CAST(item_id AS varchar), ',' ORDER BY CAST(item_id AS varchar))
                       AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
           coalesce(ids.n_items, 0) AS n_items, sha256(coalesce(ids.ids, '')) AS items_sha256,
           coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN ids USING (doc_id)"""


def _near_sql(words: str, n: int, p: int, q: int) -> str:
    """Common tables: documents d, set sizes z, links e (both ways), least doc_id reachable r."""
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter({words}, lambda x: x <> '') AS w FROM documents),
    g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), {n}) - 1), ' ') AS g
          FROM (SELECT *, unnest(range(1, greatest(len(w) - {n}, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
    z AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM g a JOIN g b USING (g)
          WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM c JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
          WHERE {q} * n >= {p} * (x.size + y.size - n)),
    reach(doc_id, other) AS (SELECT a, b FROM e
                             UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.other = e.a),
    r AS (SELECT doc_id, least(doc_id, min(other)) AS least_id FROM reach GROUP BY doc_id)"""


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD_SQL = f"""{_near_sql(_WORDS_SQL.format("text"), 5, 4, 5)}
    SELECT w.doc_id, coalesce(least_id, w.doc_id) AS class_id, coalesce(l.n, 0) AS n_links
    FROM w LEFT JOIN r USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, count(*) AS n FROM e GROUP BY a) l USING (doc_id)"""

_ONE_PERMUTATION_SQL = f"""
    {_near_sql(f"string_split_regex({_LOWER_SQL}, '[\\x20\\x09-\\x0D]+')", 3, 85, 100)}
    SELECT w.doc_id, coalesce(size, 0) AS n_shingles, coalesce(least_id, w.doc_id) AS component_id,
           coalesce(least_id, w.doc_id) = w.doc_id AS kept
    FROM w LEFT JOIN r USING (doc_id) LEFT JOIN z USING (doc_id)"""

_COLLOCATIONS_SQL = f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(string_split_regex({_LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece
               FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
          FROM p),
    s AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM w),
    g AS (SELECT lang, size, list_slice(w, i, i + size - 1) AS words, count(*) AS a
          FROM s, (VALUES (1), (2), (3)) sizes(size) WHERE i + size - 1 <= len(w) GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(a) AS bigint) AS n FROM g WHERE size = 1 GROUP BY lang),
    c AS (SELECT * FROM g WHERE size >= 2 AND a >= 10),
    longer AS (SELECT lang, words, max(a) AS a FROM (
                   SELECT lang, list_slice(words, 1, 2) AS words, a FROM c WHERE size = 3
                   UNION ALL SELECT lang, list_slice(words, 2, 3), a FROM c WHERE size = 3)
               GROUP BY lang, words),
    cuts AS (SELECT c.lang, c.words, c.a, k, l.a AS l, r.a AS r,
                    CAST(CAST(1000000 AS hugeint) * c.a * c.a // (CAST(l.a AS hugeint) * r.a) AS bigint)
                        AS score
             FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
             JOIN g l ON l.lang = c.lang AND l.words = list_slice(c.words, 1, k)
             JOIN g r ON r.lang = c.lang AND r.words = list_slice(c.words, k + 1, c.size)),
    best AS (SELECT * FROM cuts
             QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
    ranked AS (SELECT best.lang, array_to_string(best.words, ' ') AS phrase, best.a, l, r, score
               FROM best LEFT JOIN longer USING (lang, words)
               WHERE longer.a IS NULL OR 100 * longer.a < 50 * best.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM ranked JOIN totals USING (lang) QUALIFY rank <= 2000"""


def _centroid_sql(k: int = 40, rounds: int = 5, size: int = 64) -> str:
    """Rounds written out: a<i> assigns vectors to centroids c<i>, s<i> sums, c<i+1> divides."""
    square = f"""CAST(list_sum(list_transform(range(1, {size + 1}),
        lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS bigint)"""
    parts = [
        f"""x AS MATERIALIZED (
        SELECT row_number() OVER () AS id, vec_id,
               list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS double)) AS bigint)) AS v
        FROM embeddings WHERE len(embedding) = {size}
         AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        f"""c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM x
        QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
        SELECT id, vec_id, x.v, c.c, {square} AS d FROM x, c{i} c
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c.c) = 1)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
        SELECT c, i, CAST(sum(v[i]) AS bigint) AS s, count(*) AS n
        FROM a{i}, range(1, {size + 1}) r(i) GROUP BY c, i)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (
        SELECT old.c, coalesce(new.v, old.v) AS v FROM c{i} old LEFT JOIN (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c) new
        USING (c))""")
    last = rounds
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, CAST(c AS int) AS cluster, d AS distance,
           CAST(sum(d) OVER (PARTITION BY c) AS bigint) AS cluster_inertia,
           CAST(sum(d) OVER () AS bigint) AS inertia,
           sha256(array_to_string(z.v, ',')) AS centroid_sha256
    FROM a{last} JOIN c{last} z USING (c)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_benchmark_decontamination": _DECONTAMINATION_SQL,
        "op6_ngram_jaccard_join": _JACCARD_SQL,
        "op11_phrase_collocations": _COLLOCATIONS_SQL,
        "op12_centroid_clustering": _centroid_sql(),
        "op13_minhash_near_dedup": _ONE_PERMUTATION_SQL,
    }
