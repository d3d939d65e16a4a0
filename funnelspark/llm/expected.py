"""SQL counterparts of the registered queries, for DuckDB. What SQL cannot express has none and is tested against brute force."""

from __future__ import annotations

from funnelspark.llm import licenses, urls

_LOWERED = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _holds(term: str) -> str:
    return f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')"


def _url_filter() -> str:
    def fits(rule: str) -> str:
        host, _, rest = rule.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}')"

    rules = ["example.org/en/1", "example.org/es/", "com/fr/", "com/de/", "org/"]
    cases = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r in rules)
    strict = " OR ".join(map(_holds, urls.STRICT))
    count = " + ".join(f"{_holds(t)}::INT" for t in urls.SOFT)
    weight = " + ".join(f"{_holds(t)}::INT * {w}" for t, w in urls.SOFT.items())
    return f"""
        WITH cut AS (
            SELECT page_id, {_LOWERED} AS low,
                translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ), ruled AS (SELECT *, CASE {cases} END AS rule FROM cut)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN {strict} THEN 'block'
            WHEN {count} >= 2 AND {weight} >= 2 THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled
    """


#: Words of the contracts, after lower-casing A-Z where they say so.
_FOLDED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK_SEPARATED = r"[^\x20\x09-\x0D]+"


def _words(table: str, key: str, pattern: str, fold: bool) -> str:
    text = "coalesce(text, '')"
    if fold:
        text = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT row_number() OVER () AS r, {key}, regexp_extract_all({text}, '{pattern}') AS w FROM {table}"


def _warc() -> str:
    # SHA-1 as 160 bits, five at a time.
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + " + " + ".join(f"{16 >> k} * cast(substr(bits, 5 * i + {k + 1}, 1) AS INT)" for k in range(5)) + ", 1)"
    return f"""
        WITH whole AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        digests AS (SELECT *, cast(cast(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits, max(page_id) OVER (PARTITION BY html) AS first FROM whole)
        SELECT page_id, cast(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: {digit}), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM digests
    """


def _decontaminate() -> str:
    return f"""
        WITH docs AS ({_words('documents', 'doc_id', _FOLDED, True)}), items AS ({_words('benchmark', 'item_id', _FOLDED, True)}),
        wanted AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
        windows AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wanted))),
        found AS (SELECT DISTINCT r, n, i, item_id FROM windows JOIN wanted USING (n, s)),
        hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS id FROM found) GROUP BY r)
        SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """


def _substrings() -> str:
    return f"""
        WITH docs AS ({_words('documents', 'doc_id', _BLANK_SEPARATED, False)}),
        windows AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs)),
        later AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS first FROM windows) WHERE first < doc_id),
        gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM later),
        kept AS (SELECT r, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS t
            FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs) ANTI JOIN gone USING (r, p) GROUP BY r)
        SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (r)
    """


def _near_duplicates() -> str:
    # Equal word lists are one node; a cell is a shingle and which occurrence of it; classes are the closure of the links.
    return f"""
        WITH RECURSIVE docs AS ({_words('documents', 'doc_id', _FOLDED, True)}),
        nodes AS (SELECT w, min(r) AS n FROM docs WHERE len(w) > 0 GROUP BY w),
        shingles AS (SELECT n, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT n, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM nodes)),
        cells AS (SELECT n, s, row_number() OVER (PARTITION BY n, s) AS o FROM shingles),
        sizes AS (SELECT n, count(*) AS size FROM cells GROUP BY n),
        shared AS (SELECT a.n AS a, b.n AS b, count(*) AS n_shared FROM cells a JOIN cells b USING (s, o) WHERE a.n <> b.n GROUP BY a.n, b.n),
        links AS (SELECT a, b FROM shared JOIN sizes x ON a = x.n JOIN sizes y ON b = y.n WHERE 10 * n_shared >= 8 * (x.size + y.size - n_shared)),
        reached AS (SELECT n AS a, n AS b FROM nodes UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
        classes AS (SELECT a AS n, min(b) AS c FROM reached GROUP BY a)
        SELECT doc_id, coalesce(min(doc_id) OVER (PARTITION BY coalesce(c, -r)), doc_id) AS class_id, count(*) OVER (PARTITION BY coalesce(c, -r)) AS class_size
        FROM docs LEFT JOIN nodes USING (w) LEFT JOIN classes USING (n)
    """


def _licenses() -> str:
    def rows(kind: str, phrases: dict[str, str]) -> list[str]:
        return [f"('{kind}:{p}', '{label}', {kind == 'phrase'}, {len(p.split()) - 1}, {k}, '{a} {b}')" for p, label in phrases.items() for k, (a, b) in enumerate(zip(p.split(), p.split()[1:]))]

    places = ", ".join(rows("phrase", licenses.PHRASES) + rows("template", licenses.TEMPLATES))
    return f"""
        WITH docs AS ({_words('documents', 'doc_id', _FOLDED, True)}), places(template, label, exact, pairs, place, pair) AS (VALUES {places}),
        rolled AS (SELECT r, i - 1 AS spot, concat(w[i], ' ', w[i + 1]) AS pair FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs)),
        votes AS (SELECT r, template, label, exact, pairs, spot - place AS diagonal, list(DISTINCT place) AS held FROM rolled JOIN places USING (pair) GROUP BY ALL),
        cut AS (SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER own > 3, TRUE) THEN 1 ELSE 0 END AS new FROM votes WINDOW own AS (PARTITION BY r, template ORDER BY diagonal)),
        spans AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM cut),
        merged AS (SELECT r, label, exact, greatest(0, min(diagonal)) AS first, len(list_distinct(flatten(list(held)))) / pairs AS share FROM spans GROUP BY r, template, label, exact, pairs, span),
        found AS (SELECT * FROM merged WHERE share >= CASE WHEN exact THEN 1 ELSE 0.75 END),
        by_doc AS (SELECT r, count(*) FILTER (WHERE exact) AS n_base, cast(min(first) FILTER (WHERE exact) AS BIGINT) AS first_word, cast(max(first) FILTER (WHERE exact) AS BIGINT) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r)
        SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
            coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
        FROM docs LEFT JOIN by_doc USING (r)
    """


def _prefix_trie() -> str:
    # A marker after each byte stands for the shift of one bit.
    shifts = ", ".join(["-1"] * 8)
    crc = f"""xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: list_concat([ord(x)::BIGINT], [{shifts}]::BIGINT[])))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
    return f"""
        WITH said AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        every AS (SELECT c, c - c % 100 AS donor, {crc} % 6 AS h FROM (SELECT DISTINCT c FROM said)),
        turns AS (SELECT every.c, 0 AS src, pos, role, text FROM every JOIN said ON said.c = donor WHERE pos <= h UNION ALL SELECT c, 1, pos, role, text FROM every JOIN said USING (c) WHERE pos > h),
        paths AS (SELECT c, coalesce(list(struct_pack(role := role, text := text) ORDER BY src, pos) FILTER (WHERE pos IS NOT NULL), []) AS path FROM every LEFT JOIN turns USING (c) GROUP BY c),
        members AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths),
        nodes AS (SELECT path[1:d] AS node, d AS depth, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(path) = d), '')) AS ends_sha256 FROM members GROUP BY ALL),
        children AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN nodes.depth > 0 THEN (n_convs - 1) * length(nodes.node[nodes.depth].text) ELSE 0 END AS own FROM nodes LEFT JOIN children USING (node, depth)),
        above AS (SELECT node, own, n_children, unnest(range(0, depth + 1)) AS depth FROM counted),
        sums AS (SELECT node[1:depth] AS node, depth, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM above GROUP BY ALL)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM counted n JOIN sums s USING (node, depth) LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
    """


def statements() -> dict[str, str]:
    return {
        "op1_url_filter": _url_filter(), "op3_warc": _warc(), "op4_licenses": _licenses(), "op5_decontaminate": _decontaminate(), "op6_substring_dedup": _substrings(), "op7_near_duplicates": _near_duplicates(), "op12_prefix_trie": _prefix_trie(),
    }
