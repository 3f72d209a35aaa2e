"""SQL counterparts of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from riskflow.llm.queries import SHARD_BYTES, TAMPERED, URL_RULES


def top_k_sql(k: int = 10, every: int = 100) -> str:
    return f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % {every} = 0
), ranked AS (
    SELECT query_id,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE rank <= {k}
"""


def url_filter_sql() -> str:
    """Without aliases: pages of the test tables have no canonical links and no refresh."""
    rules = ", ".join(map(str, URL_RULES))
    return f"""
WITH rules(r_host, r_path, action) AS (VALUES {rules}),
located AS (
    SELECT page_id, coalesce(url, '') AS u FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM located
), fitting AS (
    SELECT page_id, r_host || r_path AS rule, action,
           row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC) AS place
    FROM parts JOIN rules
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT p.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts p LEFT JOIN (SELECT * FROM fitting WHERE place = 1) f ON p.page_id = f.page_id
"""


def sharding_sql(limit: int = SHARD_BYTES) -> str:
    """For distinct, present ids: only their digests' bits decide."""
    return f"""
WITH d AS (
    SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
           lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits
    FROM documents
), depths AS (
    SELECT CAST(unnest(generate_series(0, 60)) AS INTEGER) AS depth
), buckets AS (
    SELECT depth, substr(bits, 1, depth) AS bucket,
           CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs
    FROM d, depths GROUP BY ALL
    HAVING sum(n_bytes) <= {limit} OR count(*) = 1
)
SELECT doc_id, n_bytes, 's' || bucket AS shard, depth, shard_bytes, shard_docs
FROM d JOIN buckets ON substr(bits, 1, depth) = bucket
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(f"{value}::UBIGINT")
    step = "xor(c >> 4, ([{}])[CAST((c & 15) + 1 AS BIGINT)])".format(", ".join(table))
    byte = step.replace("c", "(" + step.replace("c", "xor(c, b)") + ")")
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def _merkle_levels(name: str, levels: int, extra: str) -> tuple[str, str]:
    """CTEs that hash ``{name}_n0`` (g, i, h, m) upwards, and that fold the rows of
    ``{name}_f0`` (g, i, f, sib and ``extra``) along the way."""
    ctes = []
    for k in range(levels):
        ctes.append(f"""
{name}_r{k} AS (
    SELECT g, i // 16 AS j, list(h ORDER BY i) AS run, any_value(m) AS m
    FROM {name}_n{k} GROUP BY g, i // 16
), {name}_n{k + 1} AS (
    SELECT g, j AS i, CASE WHEN m > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h,
           (m + 15) // 16 AS m
    FROM {name}_r{k}
)""")
    for k in range(levels):
        place = f"CAST(f.i // {16**k} % 16 AS INTEGER)"
        left = f"array_to_string(run[1:{place}], '')"
        right = f"array_to_string(run[{place} + 2:], '')"
        ctes.append(f"""
{name}_f{k + 1} AS (
    SELECT f.g, f.i, {extra},
           CASE WHEN m > 1 THEN sha256({left} || f || {right}) ELSE f END AS f,
           sib || CASE WHEN m > 1 THEN {left} || {right} ELSE '' END AS sib
    FROM {name}_f{k} f JOIN {name}_r{k} r ON f.g IS NOT DISTINCT FROM r.g AND f.i // {16 ** (k + 1)} = r.j
)""")
    return ",".join(ctes[:levels]), ",".join(ctes[levels:])


def merkle_sql(levels: int = 5, source_levels: int = 3) -> str:
    """For distinct, present ids, up to ``16 ** levels`` documents a source."""

    def leaf(text: str) -> str:
        fields = ("doc_id", "source", "lang", "n_chars", text)
        parts = (
            f"CASE WHEN {x} IS NULL THEN '-'"
            f" ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"
            for x in fields
        )
        return f"sha256({' || '.join(parts)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    up, fold = _merkle_levels("d", levels, "doc_id, leaf")
    source_up, source_fold = _merkle_levels("s", source_levels, "doc_id, leaf, subroot")
    return f"""
WITH leaves AS (
    SELECT doc_id, source, {leaf("text")} AS leaf,
           CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % {TAMPERED} = 0
                THEN {leaf(lower)} ELSE {leaf("text")} END AS tampered,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS size
    FROM documents
), d_n0 AS (
    SELECT source AS g, place AS i, leaf AS h, size AS m FROM leaves
), d_f0 AS (
    SELECT source AS g, place AS i, doc_id, leaf, tampered AS f, '' AS sib FROM leaves
), {up}, {fold},
s_n0 AS (
    SELECT 1 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, count(*) OVER () AS m, g AS own
    FROM d_n{levels}
), s_f0 AS (
    SELECT 1 AS g, s.i, f.doc_id, f.leaf, s.h AS subroot, f.f, f.sib
    FROM d_f{levels} f JOIN s_n0 s ON f.g IS NOT DISTINCT FROM s.own
), {source_up}, {source_fold}
SELECT doc_id, leaf, subroot, h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = h AS verified
FROM s_f{source_levels}, s_n{source_levels}
"""


ORACLE = {
    "op2_norm_bucketed_top_k": top_k_sql(),
    "op5_url_filter": url_filter_sql(),
    "op9_extendible_sharding": sharding_sql(),
    "op12_merkle_manifest": merkle_sql(),
}
