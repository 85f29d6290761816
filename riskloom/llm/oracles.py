"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from riskloom.llm.license_scan import DRIFT, GRAM, LOWER, NOTICE, TEMPLATES, UPPER

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license() -> str:
    rows = []
    for number, t in enumerate(TEMPLATES):
        words = t.words.split()
        n = len(words) - GRAM + 1
        rows += [f"('{' '.join(words[i : i + GRAM])}', {number}, '{t.label}', {str(t.base).lower()}, {i}, {n})" for i in range(n)]
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(GRAM))
    return f"""
        WITH templates(gram, template, label, base, spot, grams) AS (VALUES {", ".join(rows)}),
        d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        g AS (SELECT r, i - 1 AS place, {gram} AS gram FROM (SELECT r, w, unnest(generate_series(1, len(w) - {GRAM - 1})) AS i FROM d)),
        votes AS (
            SELECT r, template, label, base, grams, place - spot AS diagonal, bit_or(CAST(1 AS BIGINT) << spot) AS bits
            FROM g JOIN templates USING (gram) GROUP BY ALL
        ),
        merged AS (
            SELECT r, label, base, grams, diagonal AS start, CASE WHEN base THEN bits ELSE bit_or(bits) OVER o END AS bits
            FROM votes WINDOW o AS (PARTITION BY r, template ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {DRIFT} FOLLOWING)
        ),
        spans AS (SELECT r, label, base, start, bit_count(bits) / CAST(grams AS DOUBLE) AS share FROM merged),
        found AS (
            SELECT r, count(*) FILTER (WHERE base AND share = 1) AS n_base,
                   min(start) FILTER (WHERE base AND share = 1) AS first_word, max(start) FILTER (WHERE base AND share = 1) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base AND share = 1) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE share >= CASE WHEN base THEN 1 ELSE {NOTICE} END) AS labels,
                   max(share) AS score
            FROM spans GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
               CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               coalesce(score, 0) AS score
        FROM d LEFT JOIN found USING (r)
    """


def _anchor_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The refinement rounds written out one after another."""
    step = []
    for i in range(rounds + 1):
        step.append(f"""
            near{i} AS MATERIALIZED (
                SELECT r, part, min({entries} * CAST(list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) + entry) AS m
                FROM p JOIN book{i} b USING (part) GROUP BY r, part
            )""")
        if i < rounds:
            step.append(f"""
            sums{i} AS (
                SELECT part, entry, spot, sum(x) AS s, count(*) AS n
                FROM (SELECT part, m % {entries} AS entry, unnest(c) AS x, unnest(range(len(c))) AS spot FROM near{i} JOIN p USING (r, part))
                GROUP BY part, entry, spot
            ),
            book{i + 1} AS MATERIALIZED (
                SELECT part, entry, coalesce(mean, b.c) AS c
                FROM book{i} b LEFT JOIN (
                    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY spot) AS mean FROM sums{i} GROUP BY part, entry
                ) USING (part, entry)
            )""")
    return f"""
        WITH v AS (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS r, vec_id, label, e
            FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS e FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        ),
        p AS MATERIALIZED (
            SELECT r, part, list_slice(e, part * len(e) // {parts} + 1, (part + 1) * len(e) // {parts}) AS c FROM v, range({parts}) AS t(part)
        ),
        book0 AS (SELECT part, r - 1 AS entry, c FROM p WHERE r <= {entries}), {",".join(step)},
        coded AS (
            SELECT r, string_agg(printf('%02x', m % {entries}), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
            FROM near{rounds} GROUP BY r
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
        FROM v JOIN coded USING (r)
    """


ORACLES = {
    "op1_license_scan": _license(),
    "op4_mtree_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
        WHERE r <= 20
    """,
    "op7_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d)
        ),
        later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM later),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op12_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        g AS (SELECT *, CAST(length(t) AS BIGINT) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT)) AS w FROM d),
        k AS (
            SELECT *, least(w[1] % (n + 1), w[2] % (n + 1)) AS a, greatest(w[1] % (n + 1), w[2] % (n + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR w[3] % 100 >= 90 THEN 'plain'
                        WHEN w[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM g
        ),
        c AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM k)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM c
    """,
    "op13_anchor_codes": _anchor_codes(),
    "op9_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
               FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
        bs AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
               FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
        shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / CAST(n_item AS DOUBLE) AS containment
        FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9
    """,
}
