"""SQL twins, for DuckDB, of the queries that SQL can express."""

#: Templates as a table: license, place in its list, text. Fixed values, stated here again.
_TEMPLATES = """
    ('MIT', 0, 'Released under the MIT License.'),
    ('MIT', 1, 'Licensed under the MIT License.'),
    ('MIT', 2, 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files'),
    ('Apache-2.0', 0, 'Licensed under the Apache License, Version 2.0.'),
    ('Apache-2.0', 1, 'you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ('GPL-3.0', 0, 'This work is licensed under the GNU General Public License, version 3.'),
    ('GPL-3.0', 1, 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License'),
    ('GPL-2.0', 0, 'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License'),
    ('LGPL', 0, 'under the terms of the GNU Lesser General Public License as published by the Free Software Foundation'),
    ('MPL-2.0', 0, 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
    ('BSD', 0, 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met'),
    ('CC-BY-NC-4.0', 0, 'Licensed under CC BY-NC 4.0.'),
    ('CC-BY-NC-4.0', 1, 'This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.'),
    ('CC-BY-4.0', 0, 'Licensed under CC BY 4.0.'),
    ('CC-BY-4.0', 1, 'This work is licensed under a Creative Commons Attribution 4.0 International License.'),
    ('CC-BY-SA-4.0', 0, 'Licensed under CC BY-SA 4.0.'),
    ('CC-BY-SA-4.0', 1, 'This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.'),
    ('All-Rights-Reserved', 0, 'All rights reserved.')"""


def _words(source: str) -> str:
    """Rows of a source with w, their words of ASCII letters and digits; those without words are left out."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT * FROM (SELECT *, regexp_extract_all({low}, '[a-z0-9]+') AS w FROM ({source})) WHERE len(w) > 0"


def _runs(size: int) -> str:
    """All distinct runs of so many words."""
    return f"list_distinct(list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' ')))"


_LEAK_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


#: Of links l (a, b), in both directions: every node that a node reaches.
_REACHED = "reached AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reached r JOIN l ON r.b = l.a)"


def _lloyd(k: int, rounds: int) -> str:
    """Every round as two tables: the nearest centroid of each vector, and the centroids after it."""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS DOUBLE)) AS HUGEINT)) AS x
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        e AS MATERIALIZED (SELECT id, j, x[j] AS x FROM v, unnest(range(1, 65)) AS t(j)),
        f AS (SELECT id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM v QUALIFY c < {k}),
        c0 AS MATERIALIZED (SELECT c, j, x AS m FROM f JOIN e USING (id))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (SELECT id, c, sum((x - m) * (x - m)) AS d FROM e JOIN c{r} USING (j) GROUP BY id, c) GROUP BY id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, c{r}.j, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{r}
                LEFT JOIN (SELECT c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM e JOIN a{r} USING (id) GROUP BY c, j) q ON q.c = c{r}.c AND q.j = c{r}.j)""")
    return f"""WITH {", ".join(parts)},
        h AS (SELECT c, sha256(string_agg(cast(m AS VARCHAR), ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c)
        SELECT vec_id, cast(c AS INTEGER) AS cluster, cast(d AS BIGINT) AS distance, cast(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               cast(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
        FROM a{rounds} JOIN v USING (id) JOIN h USING (c)"""


ORACLES: dict[str, str] = {
    # Templates of five words and more by their shingles, shorter ones as a run of all their words anywhere in a text.
    "op1_license_scan": f"""
        WITH t AS (SELECT license, template, w, len(w) AS n, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE {_runs(5)} END AS own
                   FROM ({_words(f"SELECT * FROM (VALUES {_TEMPLATES}) AS v(license, template, text)")})),
             d AS MATERIALIZED (SELECT *, row_number() OVER () AS id FROM ({_words("SELECT doc_id, text FROM documents")})),
             s AS (SELECT license, template, n, len(own) AS size, unnest(own) AS s FROM t),
             r AS (SELECT id, doc_id, unnest({_runs(5)}) AS s FROM d WHERE len(w) >= 5),
             long AS (SELECT id, doc_id, license, template, count(*) AS matched, size FROM r JOIN s USING (s) WHERE n >= 5 GROUP BY ALL),
             short AS (SELECT id, doc_id, license, template, 1 AS matched, 1 AS size FROM d, t
                       WHERE n < 5 AND contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || array_to_string(t.w, ' ') || ' '))
        SELECT doc_id, license, cast(template AS INTEGER) AS template, cast(matched AS INTEGER) AS matched, cast(size AS INTEGER) AS size
        FROM (SELECT * FROM long UNION ALL SELECT * FROM short) WHERE 100 * matched >= 75 * size
    """,
    "op4_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
             n AS (SELECT *, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
                          count(*) OVER (PARTITION BY plain) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM n
    """,
    "op5_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, cast(embedding AS DOUBLE[]) AS e FROM embeddings
                             WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                                WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
             {_REACHED}
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, m) AS component_id, vec_id = least(vec_id, m) AS kept
        FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a) USING (vec_id)
        LEFT JOIN (SELECT a AS vec_id, min(b) AS m FROM reached GROUP BY a) USING (vec_id)
    """,
    # One row for each doc_id, which is unique in the given tables.
    "op6_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE {_runs(5)} END AS s FROM d),
             k AS MATERIALIZED (SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS class_id FROM s GROUP BY 1, 2),
             u AS (SELECT class_id, n, unnest(s) AS x FROM k),
             l AS MATERIALIZED (SELECT a.class_id AS a, b.class_id AS b FROM u a JOIN u b ON a.x = b.x AND a.class_id <> b.class_id
                                GROUP BY a.class_id, b.class_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
             {_REACHED}
        SELECT doc_id, cast(n AS BIGINT) AS n_shingles, CASE WHEN n > 0 THEN class_id END AS class_id,
               CASE WHEN n > 0 THEN least(class_id, coalesce(m, class_id)) ELSE doc_id END AS component_id
        FROM (SELECT doc_id, list_sort(s) AS s FROM s) JOIN k USING (s) LEFT JOIN (SELECT a AS class_id, min(b) AS m FROM reached GROUP BY a) USING (class_id)
    """,
    "op11_decontamination": f"""
        WITH b AS (SELECT cast(item_id AS VARCHAR) AS item_id, {_LEAK_WORDS} AS w FROM benchmark),
             k AS (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
             i AS (SELECT DISTINCT item_id, n, array_to_string(w[j:j + n - 1], ' ') AS s
                   FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS j FROM k)),
             d AS (SELECT row_number() OVER () AS id, doc_id, {_LEAK_WORDS} AS w FROM documents),
             o AS (SELECT id, n, j, array_to_string(w[j:j + n - 1], ' ') AS s
                   FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS j FROM d, (SELECT DISTINCT n FROM i))),
             h AS (SELECT id, n, j, item_id FROM o JOIN i USING (s, n)),
             c AS (SELECT id, count(*) AS n_hit FROM (SELECT DISTINCT id, unnest(range(j, j + n)) AS at FROM h) GROUP BY id),
             t AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
                   FROM (SELECT DISTINCT id, item_id FROM h) GROUP BY id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (id) LEFT JOIN t USING (id)
    """,
    "op12_centroid_clustering": _lloyd(8, 10),
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
             g AS (SELECT lang, w[j:j + size - 1] AS words
                   FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS j FROM w, unnest(range(1, 6)) AS s(size))),
             n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
             f AS MATERIALIZED (SELECT lang, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
             x AS (SELECT lang, words[j:j + size - 1] AS words, max(f) AS more
                   FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS j FROM f, unnest(range(2, 5)) AS s(size) WHERE size < len(words))
                   GROUP BY ALL),
             c AS (SELECT f.* FROM f LEFT JOIN x USING (lang, words) WHERE len(words) > 1 AND (more IS NULL OR 100 * more < 100 * f)),
             k AS (SELECT lang, words, f AS a, unnest(range(1, len(words))) AS k FROM c),
             s AS (SELECT k.lang, k.words, a, l.f AS l, r.f AS r, n, k, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
                   FROM k JOIN n ON k.lang = n.lang JOIN f l ON l.lang = k.lang AND l.words = k.words[:k]
                   JOIN f r ON r.lang = k.lang AND r.words = k.words[k + 1:]),
             b AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score FROM s
                   QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
               cast(n AS BIGINT) AS n, cast(score AS BIGINT) AS score
        FROM b QUALIFY rank <= 2000
    """,
}
