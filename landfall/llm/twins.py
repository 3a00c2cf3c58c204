"""SQL twins that are built from parts."""

from __future__ import annotations

from landfall.llm.centroid_clustering import Clustering
from landfall.llm.url_filter import RULES, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_filter(rules: tuple[Rule, ...] = RULES) -> str:
    """Links are found where tags are spelt plainly and name whole URLs."""
    values = ", ".join(f"('{r.host}', '{r.path}', '{'allow' if r.allow else 'block'}')" for r in rules)

    def host(url: str) -> str:
        return f"translate(regexp_extract({url}, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"

    def address(url: str) -> str:
        scheme = f"translate(regexp_extract({url}, '^([^:/?#]+://[^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
        return f"nullif({scheme}, '') || regexp_extract({url}, '^[^:/?#]+://[^/?#]*([^#]*)', 1)"

    def judged(rows: str, key: str) -> str:
        return f"""SELECT u.*, r.host || r.path AS rule, r.verdict AS ruled FROM {rows} u LEFT JOIN rules r
            ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
            QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY length(r.host || r.path) DESC NULLS LAST, length(r.host) DESC) = 1"""

    path = "regexp_extract({0}, '://[^/?#]*([^?#]*)', 1)"
    return f"""
        WITH RECURSIVE rules(host, path, verdict) AS (VALUES {values}),
        rows AS (
            SELECT row_number() OVER () AS row_no, page_id, url, html, coalesce({host('url')}, '') AS host,
                   coalesce({path.format('url')}, '') AS path, {address('url')} AS address
            FROM pages
        ), ruled AS ({judged('rows', 'u.row_no')}),
        named AS (
            SELECT url, unnest(list_concat(
                regexp_extract_all(html, '<link rel="canonical" href="([^"]+)"', 1),
                regexp_extract_all(html, '<meta http-equiv="refresh" content="[0-9]+; ?url=([^"]+)"', 1))) AS target
            FROM pages WHERE url IS NOT NULL AND html IS NOT NULL
        ), links AS (
            SELECT {address('url')} AS a, {address('target')} AS b FROM named
        ), edges AS (
            SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b
        ), nodes AS (
            SELECT DISTINCT a AS node, {host('a')} AS host, {path.format('a')} AS path FROM edges
        ), blocked AS (
            SELECT node FROM ({judged('nodes', 'u.node')}) WHERE ruled = 'block'
            UNION SELECT e.b FROM blocked JOIN edges e ON e.a = blocked.node
        )
        SELECT page_id, host, path, rule,
               coalesce(ruled, CASE WHEN address IN (SELECT node FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled"""


def centroid_clustering(how: Clustering = Clustering()) -> str:
    """Lloyd's rounds one after the other, every distance computed in each."""
    ctes = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS row_no, vec_id,
                   list_transform(embedding, lambda x: cast(floor({how.scale} * cast(x AS double)) AS bigint)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = {how.width}
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
            SELECT row_no, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM kept
        ), firsts AS (
            SELECT row_no, row_number() OVER (ORDER BY sha256('{how.seed}' || vec_id), v) - 1 AS num
            FROM kept WHERE vec_id IS NOT NULL ORDER BY num LIMIT {how.k}
        ), c0 AS MATERIALIZED (
            SELECT num, pos, x FROM firsts JOIN parts USING (row_no)
        )"""]
    for r in range(how.rounds + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (
            SELECT row_no, num, d FROM (
                SELECT p.row_no, c.num, sum((p.x - c.x) * (p.x - c.x)) AS d
                FROM parts p JOIN c{r} c USING (pos) GROUP BY p.row_no, c.num
            ) QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY d, num) = 1
        )""")
        if r < how.rounds:
            ctes.append(f"""c{r + 1} AS MATERIALIZED (
                SELECT c.num, c.pos, cast(CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS bigint) AS x
                FROM c{r} c LEFT JOIN (
                    SELECT num, pos, sum(x) AS s, count(*) AS n FROM parts JOIN a{r} USING (row_no) GROUP BY num, pos
                ) m USING (num, pos)
            )""")
    last = how.rounds
    return f"""
        WITH {', '.join(ctes)}, digests AS (
            SELECT num, sha256(string_agg(cast(x AS varchar), ',' ORDER BY pos)) AS centroid_sha256 FROM c{last} GROUP BY num
        )
        SELECT vec_id, cast(num AS integer) AS cluster, cast(d AS bigint) AS distance,
               cast(sum(d) OVER (PARTITION BY num) AS bigint) AS cluster_inertia, cast(sum(d) OVER () AS bigint) AS inertia,
               centroid_sha256
        FROM a{last} JOIN kept USING (row_no) JOIN digests USING (num)"""


SOURCE_DIVERGENCE = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents
    ), words AS (
        SELECT doc, lang, source, translate(term, '{_UPPER}', '{_LOWER}') AS term
        FROM (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs)
    ), kept AS MATERIALIZED (
        SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
    ), groups AS (
        SELECT DISTINCT lang, source FROM docs
    ), counts AS MATERIALIZED (
        SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
    ), langs AS (
        SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
    ), sizes AS (
        SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source
    ), shares AS MATERIALIZED (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + cast(1000000000 AS hugeint) * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + l.v) AS p,
               1 + cast(1000000000 AS hugeint) * (k.total + 1) // (l.n + l.v) AS q
        FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
    ), gaps AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), parts AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(gaps.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, cast(value AS bigint) AS value,
           cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS integer) AS rank
    FROM parts QUALIFY part = 'pair' OR rank <= 200"""
