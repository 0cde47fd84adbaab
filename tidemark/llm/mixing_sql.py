"""The mix as one DuckDB query."""

from tidemark.llm.mixing import BLOCK, CAP, SEED, SHARD_BLOCKS, SHARDS, SHARE, WEIGHTS


def apportion(source: str, group: str, name: str, vote: str) -> str:
    """Seats by highest quotients; source has ``seats`` on every row."""
    part = f"PARTITION BY {group}" if group else ""
    keys = ", ".join(filter(None, [group, name]))
    order = ", ".join(f"{c} NULLS LAST" for c in name.split(", "))
    return f"""(WITH v AS (SELECT *, CAST(sum({vote}) OVER ({part}) AS DOUBLE) AS v, count(*) OVER ({part}) AS n FROM {source}),
    q AS (SELECT *, CASE WHEN v > 0 THEN {vote} * seats / v ELSE 0 END AS quota, CAST(ceil(CASE WHEN v > 0 THEN n * {vote} / v ELSE 0 END) AS BIGINT) + 1 AS slack FROM v),
    b AS (SELECT *, greatest(0, CAST(floor(quota) AS BIGINT) - slack) AS lo, CAST(floor(quota) AS BIGINT) + slack + 1 AS hi FROM q),
    o AS (SELECT *, seats - sum(lo) OVER ({part}) AS free FROM b),
    j AS (SELECT *, unnest(generate_series(lo + 1, hi)) AS j FROM o),
    r AS (SELECT *, row_number() OVER ({part} ORDER BY CAST({vote} AS DOUBLE) / CAST(2 * j - 1 AS DOUBLE) DESC, {order}, j) AS place FROM j)
    SELECT {keys}, any_value({vote}) AS {vote}, CAST(any_value(lo) + sum(CASE WHEN place <= free AND {vote} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS won FROM r GROUP BY {keys})"""


HASH = "CAST('0x' || substr(md5('" + SEED + "/' || coalesce(CAST(doc_id AS VARCHAR), '-') || '/' || dup || '/' || b), 1, 15) AS BIGINT)"

ORACLE = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source NULLS FIRST, size) AS dup FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum((size + {BLOCK - 1}) // {BLOCK}) AS BIGINT) AS blocks FROM numbered GROUP BY source),
w AS (SELECT *, CAST(list_extract([{", ".join(map(str, WEIGHTS))}], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS BIGINT)) AS DOUBLE) AS w,
  CAST(source_size * {CAP} AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * CAST({SHARE} AS DOUBLE)
    - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT arg_min(level, cap / w) AS found FROM l WHERE level * w <= cap),
t AS (SELECT source, source_size, blocks, least(cap, w * found) AS target FROM l, f),
seated AS (SELECT source, target, CAST(floor(sum(target) OVER () / CAST({BLOCK} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS seats FROM t),
given AS (SELECT a.source, a.won AS seats, greatest(1, least({SHARDS}, (blocks + {SHARD_BLOCKS - 1}) // {SHARD_BLOCKS})) AS shards
  FROM {apportion("seated", "", "source", "target")} a JOIN t ON a.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, {HASH} AS spot FROM (SELECT *, unnest(generate_series(0, (size + {BLOCK - 1}) // {BLOCK} - 1)) AS b FROM numbered WHERE size > 0)),
placed AS (SELECT doc_id, dup, b, c.source AS src, seats, spot, spot % shards AS shard, least({BLOCK}, size - b * {BLOCK}) AS words
  FROM cut c JOIN given g ON c.source IS NOT DISTINCT FROM g.source),
held AS (SELECT src, shard, CAST(sum(words) AS BIGINT) AS held, any_value(seats) AS seats FROM placed GROUP BY src, shard),
quota AS (SELECT src, shard, held, least(won * {BLOCK}, held * {CAP}) AS quota FROM {apportion("held", "src", "shard", "held")}),
ordered AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY src, shard ORDER BY spot, doc_id, dup, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
taken AS (SELECT doc_id, dup, sum(words * (quota // held) + greatest(0, least(words, quota - (quota // held) * held - before))) AS taken
  FROM ordered o JOIN quota q ON o.src IS NOT DISTINCT FROM q.src AND o.shard = q.shard GROUP BY doc_id, dup)
SELECT r.doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM numbered r JOIN t ON r.source IS NOT DISTINCT FROM t.source
  LEFT JOIN taken k ON r.doc_id IS NOT DISTINCT FROM k.doc_id AND r.dup = k.dup
"""
