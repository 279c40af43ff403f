"""DuckDB SQL for the queries' results."""

from __future__ import annotations

from tidewater.llm.quality_rules import COST, CUTOFFS, RULES

_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"
_WORDS = f"list_filter(string_split(translate(coalesce(text,''), {_SPACES}, '      '), ' '), lambda x: x <> '')"


def _quality(source: str = "documents", alpha: float = 0.02, delta: float = 0.05) -> str:
    """The rules' decisions on the rows of ``source``."""
    cutoffs = ", ".join(f"({i}, {c})" for i, c in enumerate(CUTOFFS))
    figures = {
        "symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"),
        "dup_lines": ("n_dup_lines", "n_lines"), "capitals": ("n_capitals", "word_chars"),
        "exclaims": ("n_exclaims", "word_chars")}
    share = alpha / len(RULES)
    return f"""
WITH body AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS w FROM {source}),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM body WHERE len(w) >= 3)),
marked AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
covered AS (SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM marked, (VALUES (0), (1), (2)) AS o(d)
            WHERE n > 1 GROUP BY r),
counts AS (SELECT r, doc_id, lang, len(w)::BIGINT AS n_words,
    length(translate(text, {_SPACES}, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::BIGINT AS n_capitals,
    (length(text) - length(translate(text, '!', '')))::BIGINT AS n_exclaims,
    list_filter(string_split(text, chr(10)), lambda x: translate(x, {_SPACES}, '') <> '') AS lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM body LEFT JOIN covered USING (r)),
lined AS (SELECT *, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts),
figures AS (SELECT *, {", ".join(
    f"CASE WHEN {b} > 0 THEN ({a} * 1000) // {b} ELSE 0 END AS {r}" for r, (a, b) in figures.items())} FROM lined),
marks AS (SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1)
          GROUP BY doc_id),
held AS ({" UNION ALL ".join(
    f"SELECT lang, '{r}' AS rule, {r} AS figure, good FROM figures JOIN marks USING (doc_id) WHERE NOT base_failed"
    for r in RULES)}),
strata AS (SELECT count(*) AS n_strata FROM (SELECT DISTINCT lang FROM held)),
tests AS (SELECT lang, rule, step, cutoff, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad,
    count(*) FILTER (good AND figure >= cutoff) AS lost, count(*) FILTER (NOT good AND figure >= cutoff) AS caught
    FROM held, (VALUES {cutoffs}) AS c(step, cutoff) GROUP BY ALL),
judged AS (SELECT tests.*, n_strata, CASE WHEN n_good > 0 AND lost <= {share!r} * n_good THEN
    list_sum(list_transform(range(0, lost + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1)
        + i * ln({share!r}) + (n_good - i) * ln(1 - {share!r})))) ELSE 1 END AS p FROM tests, strata),
run AS (SELECT *, sum(CASE WHEN p <= {delta!r} / (n_strata * {len(RULES)}) THEN 0 ELSE 1 END) OVER (
    PARTITION BY lang, rule ORDER BY step) AS failed FROM judged),
scored AS (SELECT *, caught / n_bad - {COST} * lost / n_good AS score FROM run WHERE failed = 0 AND caught > 0),
best AS (SELECT lang, rule, cutoff FROM (SELECT *, row_number() OVER (
    PARTITION BY lang, rule ORDER BY score DESC, cutoff DESC) AS k FROM scored) WHERE k = 1 AND score > 0),
hit AS (SELECT DISTINCT r FROM figures JOIN best ON figures.lang IS NOT DISTINCT FROM best.lang AND ({" OR ".join(
    f"(best.rule = '{r}' AND figures.{r} >= best.cutoff)" for r in RULES)}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND r NOT IN (SELECT r FROM hit) AS kept FROM figures"""


QUALITY = _quality()

TOP_K = """
WITH good AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

URLS = r"""
WITH cut AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parsed AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
keys AS (SELECT host || path AS key FROM parsed WHERE host || path <> '' GROUP BY 1 HAVING count(*) > 1),
rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, host, path,
    (SELECT max_by(r.host || r.path, length(r.host || r.path)) FROM rules r WHERE (p.host = r.host OR
        suffix(p.host, '.' || r.host)) AND prefix(p.path, r.path)) AS rule,
    coalesce((SELECT max_by(r.verdict, length(r.host || r.path)) FROM rules r WHERE (p.host = r.host OR
        suffix(p.host, '.' || r.host)) AND prefix(p.path, r.path)),
        CASE WHEN p.host || p.path IN (SELECT key FROM keys) THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p"""


def _clusters(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """k-means rounds in whole numbers: ``c0`` to ``c5`` are the centroids, ``a0`` to ``a5`` the vectors' nearest ones."""
    steps = [f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS cluster, x AS c
    FROM kept WHERE vec_id IS NOT NULL QUALIFY cluster < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS (SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT r, cluster, list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT AS d
    FROM kept, c{n}) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
    FROM kept JOIN a{n} USING (r), range(1, 65) AS p(i) GROUP BY cluster, i),
c{n + 1} AS (SELECT cluster, coalesce(moved, c) AS c FROM c{n} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM s{n} GROUP BY cluster) USING (cluster))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
{", ".join(steps)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} USING (cluster)"""


CLUSTERS = _clusters()
