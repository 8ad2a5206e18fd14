"""SQL for the queries that SQL can express, written apart from the Spark plans."""

from __future__ import annotations

from tallyhouse.llm import licenses


def _quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def op9() -> str:
    """Words, phrase places and template containment by lists; every block of lines and every run of words with every template."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    places = []
    for phrase, label in licenses.PHRASES.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        places.append(f"list_transform(list_filter(range(greatest(len(w) - {len(words) - 1}, 0)), lambda i: {same}), lambda i: {{'at': i, 'label': '{label}'}})")
    templates = " UNION ALL ".join(f"SELECT '{label}' AS label, {licenses.run_of(t, licenses.THRESHOLD)} AS run, {_quoted(licenses.words_of(t))} AS t" for label, t in licenses.TEMPLATES)
    return f"""WITH low AS (SELECT doc_id, translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}') AS text FROM documents),
    words AS (SELECT doc_id, regexp_extract_all(text, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w, list_transform(string_split(text, chr(10)), lambda x: list_distinct(regexp_extract_all(x, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'))) AS lines FROM low),
    base AS (SELECT doc_id, len(w) AS n_words, list_concat({places[0]}, list_concat({places[1]}, list_concat({places[2]}, {places[3]}))) AS p FROM words),
    blocks AS (SELECT doc_id, list_distinct(flatten(lines[unnest(range(1, len(lines) + 1)) : unnest(range(1, len(lines) + 1)) + {licenses.SPAN - 1}])) AS b FROM words),
    templates AS ({templates}),
    near AS (SELECT doc_id, label, t, w, run FROM words, templates WHERE len(list_intersect(list_distinct(w), t)) >= ceil({licenses.THRESHOLD} * len(t) - 1e-9)),
    runs AS (SELECT doc_id, label, t, list_max(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_contains(t, w[i]) THEN len(list_intersect(list_distinct(w[i : i + run - 1]), t)) ELSE 0 END)) AS shared FROM near),
    found AS (SELECT doc_id, label, max(shared / len(t)) AS best FROM (SELECT doc_id, label, t, len(list_intersect(b, t)) AS shared FROM blocks, templates UNION ALL SELECT doc_id, label, t, shared FROM runs)
      WHERE shared >= ceil({licenses.THRESHOLD} * len(t) - 1e-9) GROUP BY 1, 2),
    more AS (SELECT doc_id, list(label) AS labels, max(best) AS best FROM found GROUP BY 1)
    SELECT doc_id, n_words, len(p) AS n_base, list_min(list_transform(p, lambda x: x.at)) AS first_word, list_max(list_transform(p, lambda x: x.at)) AS last_word,
      array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
      array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), coalesce(labels, [])))), ',') AS labels, CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
    FROM base LEFT JOIN more USING (doc_id)"""


def op5() -> str:
    """Spans from the pieces between matches, owners of each value by hash."""
    kinds = {"assign": ("((?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8), "access": ("AKIA[A-Z0-9]+", 0, 16), "hex": ("[0-9a-f]+", 0, 32), "opaque": ("[A-Za-z0-9+/_-]+", 0, 24)}
    hits = []
    for rank, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        extra = " AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')" if kind == "opaque" else ""
        hits.append(f"""SELECT doc_id, source, {rank} AS rank, '{kind}' AS kind, e - length(m) AS s, e, v FROM (
          SELECT doc_id, source, m, v, sum(length(m) + length(gap)) OVER (PARTITION BY doc_id ORDER BY k) AS e FROM (
            SELECT doc_id, source, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(vs) AS v, unnest(gaps[1 : len(ms)]) AS gap FROM (
              SELECT doc_id, source, regexp_extract_all(text, '{pattern}') AS ms, regexp_extract_all(text, '{pattern}', {group}) AS vs, string_split_regex(text, '{pattern}') AS gaps FROM documents WHERE text IS NOT NULL))
        ) WHERE length(v) >= {least}{extra}""")
    return f"""WITH hits AS ({' UNION ALL '.join(hits)}),
    owned AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repos FROM hits GROUP BY 1),
    known AS (SELECT hits.*, owners, repos, owners < 3 AND repos < 100 AS live FROM hits JOIN owned USING (v)),
    kept AS (SELECT * FROM known WHERE kind <> 'opaque' UNION ALL SELECT * FROM known o WHERE kind = 'opaque' AND owners = 1
      AND NOT EXISTS (SELECT 1 FROM known b WHERE b.kind <> 'opaque' AND b.doc_id = o.doc_id AND o.s < b.e AND b.s < o.e)),
    per AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE kind <> 'opaque') AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
      count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_example, max(owners) AS most_owners, max(repos) AS most_repos FROM kept GROUP BY 1)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
      coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos FROM documents LEFT JOIN per USING (doc_id)"""


def op11(k: int = 5) -> str:
    """Every query with every other row."""
    return f"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""


def op12(k: int = 20) -> str:
    """Every item's terms with every document's."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = f"unnest(regexp_extract_all(translate(text, '{capitals}', '{capitals.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'))"
    return f"""WITH d AS (SELECT doc_id, {split} AS t FROM documents), q AS (SELECT item_id, {split} AS t FROM benchmark),
    tfs AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY 1, 2), sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS occurrences FROM sizes),
    weight AS (SELECT t, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, total GROUP BY t),
    norm AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // occurrences) AS m FROM sizes, total),
    scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN tfs USING (t) JOIN weight USING (t) JOIN norm USING (doc_id) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""


def op13() -> str:
    """Damage with a table-driven CRC, and the least (cost, edits) of every node, row by row."""
    edits = [(node, f"left(role, 1) = '{initial}' AND NOT gone", "3 * cut", "K", "[role || ':' || text]", to) for node, initial, to in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2))]
    fills = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    edits += [(node, "NOT gone", "3 + 3 * cut", "R", f"['{role}:' || text]", to) for node, (role, to) in fills.items()]
    edits += [(node, "true", "4", "D", "CAST([] AS VARCHAR[])", node) for node in range(4)]
    step = " UNION ALL ".join(f"SELECT conv_id, i, {to} AS node, cost + {cost} AS cost, audit || '{edit}' AS audit, list_concat(lines, {line}) AS lines FROM met WHERE node = {node} AND {where}" for node, where, cost, edit, line, to in edits)

    def insert(source: str, node: str = "node") -> str:
        role = f"CASE WHEN {node} = 2 THEN 'assistant' ELSE 'user' END"
        return f"SELECT conv_id, i, CASE WHEN {node} = 2 THEN 3 ELSE 2 END AS node, cost + 3 AS cost, audit || 'I' AS audit, list_append(lines, {role} || ':') AS lines FROM {source}"

    least = "SELECT conv_id, i, node, min({'cost': cost, 'audit': audit, 'lines': lines}) AS best FROM {source} GROUP BY conv_id, i, node"
    opened = lambda source: f"(SELECT conv_id, i, node, best.cost AS cost, best.audit AS audit, best.lines AS lines FROM {source})"
    best = lambda source: least.replace("{source}", source)
    return f"""WITH RECURSIVE tab AS (SELECT list(list_reduce(list_prepend(CAST(n AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))) AS l FROM conversations),
    coded AS (SELECT conv_id, turn, role, text, xor(list_reduce(l, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM keyed, tab),
    damaged AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
    ended AS (SELECT *, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
      left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM placed),
    rows_ AS (SELECT *, last = '' AS blank, last <> '' AND again AS duplicate, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated FROM ended),
    coded_rows AS (SELECT conv_id, i, role, text, blank OR duplicate AS gone, CAST(truncated AS INTEGER) AS cut FROM rows_),
    begun AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS node, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM conversations),
    dp AS (
      SELECT * FROM (SELECT * FROM begun UNION ALL {insert('begun')} UNION ALL {insert('(' + insert('begun') + ')')})
      UNION ALL
      SELECT * FROM (WITH met AS (SELECT dp.conv_id, dp.i + 1 AS i, node, cost, audit, lines, role, text, gone, cut FROM dp JOIN coded_rows r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1),
        used AS ({step}), first AS ({best('used')}), filled AS (SELECT * FROM {opened('first')} UNION ALL {insert(opened('first'))} UNION ALL {insert('(' + insert(opened('first')) + ')')}), second AS ({best('filled')})
        SELECT * FROM {opened('second')})),
    size AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
      count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id),
    done AS (SELECT dp.conv_id, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS best FROM dp LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM dp.conv_id WHERE dp.i = coalesce(n, 0) AND node IN (0, 3) GROUP BY dp.conv_id)
    SELECT done.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
      sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256 FROM done LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM done.conv_id"""
