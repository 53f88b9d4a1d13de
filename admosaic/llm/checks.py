"""SQL for the rows of the registered queries, written apart from the operators."""

SPACES = r"[\x20\x09-\x0D]+"

# The function words of the quality rules.
_STOP = (
    "the be to of and that have with in is it for was on are as by this a "
    "der die das und ist von zu den mit nicht ein eine auf für im es sich auch "
    "le la les de des et un une du est dans que pour pas sur avec au "
    "el los las y en una por con para se del al lo no su"
)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(t, '{SPACES}'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), twice AS (
  SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{SPACES}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(w, lambda x: list_contains(string_split('{_STOP}', ' '), lower(x))))::BIGINT AS n_stop_words,
    len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipsis_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')))::BIGINT AS n_bullet_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)
), f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    list_filter([
      CASE WHEN NOT 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words THEN 'mean_word_length' END,
      CASE WHEN 100 * n_symbols > 30 * n_words THEN 'symbols_per_word' END,
      CASE WHEN 100 * n_stop_words < 3 * n_words THEN 'stop_words' END,
      CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 'duplicate_lines' END,
      CASE WHEN 100 * n_ellipsis_lines > 50 * n_lines THEN 'ellipsis_lines' END,
      CASE WHEN 100 * n_bullet_lines > 90 * n_lines THEN 'bullet_lines' END,
      CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END], lambda x: x IS NOT NULL) AS fails
  FROM c
)
SELECT * EXCLUDE (fails), '[' || array_to_string(fails, ', ') || ']' AS failed_rules,
       NOT base_failed AND len(fails) = 0 AS kept
FROM f
"""

NON_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _plain_words(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), {_A_Z}), '{NON_WORDS}'), lambda x: x <> '')"


DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_plain_words("text")} AS w FROM documents
), b AS (
  SELECT item_id, w FROM (SELECT item_id, {_plain_words("text")} AS w FROM benchmark) WHERE len(w) > 0
), p AS (
  SELECT item_id, w[i:least(i + 9, len(w))] AS p FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b)
), pl AS (
  SELECT DISTINCT p FROM p
), occ AS (
  SELECT r, w, i, w[i] AS t FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), df AS (
  SELECT lower(t) AS dt, count(*) AS n FROM occ GROUP BY 1
), rk AS (
  SELECT p, first(lower(q.t) ORDER BY coalesce(n, 0), o) AS t1, min(coalesce(n, 0)) AS least
  FROM (SELECT p, o, p[o] AS t FROM (SELECT p, unnest(range(1, len(p) + 1)) AS o FROM pl)) q LEFT JOIN df ON lower(q.t) = df.dt
  GROUP BY p
), first_word AS (
  SELECT p, p[1] AS a FROM pl
), hits AS (
  SELECT r, i, len(p) AS n, p FROM occ JOIN first_word ON occ.t = a WHERE w[i:i + len(p) - 1] = p
), n_hit AS (
  SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM hits) GROUP BY r
), its AS (
  SELECT r, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) AS items FROM hits JOIN p USING (p) GROUP BY r
), near AS (
  SELECT r, count(DISTINCT item_id) AS near_items
  FROM occ JOIN rk ON lower(occ.t) = t1 JOIN p USING (p)
  WHERE rk.least > 0 AND list_has_all(w[greatest(i - 9, 1):i + 9], p) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(near_items, 0)::BIGINT AS near_items
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN its USING (r) LEFT JOIN near USING (r)
"""

# The patterns of the secret kinds.
_SECRET_KINDS = (
    ("assign", 6, r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""),
    ("access", 20, r"()(AKIA[A-Z0-9]+)"),
    ("hex", 24, r"()([0-9a-f]+)"),
    ("vendor", 20, r"()((?:gh[opsu]_|xox[abp]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,})"),
    ("blob", 40, r"()([A-Za-z0-9+/]{40,})"),
)
_MARKED = " UNION ALL ".join(
    f"SELECT r, {k} AS o, '{name}' AS kind, {least} AS least, string_split(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', "
    f"chr(1) || '\\1' || chr(3) || '\\2' || chr(1), 'g'), chr(1)) AS p FROM d"
    for k, (name, least, pattern) in enumerate(_SECRET_KINDS)
)

SECRETS = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, regexp_replace(coalesce(text, ''), '[\\x01-\\x03]', chr(4), 'g') AS t FROM documents
), m AS (
  {_MARKED}
), piece AS (
  SELECT r, o, kind, least, i, p[i] AS x, length(replace(p[i], chr(3), '')) AS n
  FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM m WHERE len(p) > 1)
), span AS (
  SELECT r, o, kind, coalesce(sum(n) OVER (PARTITION BY r, o ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
         n, i, least, string_split(x, chr(3))[2] AS v
  FROM piece
), good AS (
  SELECT r, o, kind, s, s + n AS e, v FROM span WHERE i % 2 = 0 AND length(v) >= least
    AND (o < 4 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))
), held AS (
  SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners FROM good JOIN d USING (r) GROUP BY v
), kept AS (
  SELECT good.*, owners FROM good JOIN held USING (v) WHERE o < 3 OR owners < 3
), a AS (
  SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) FILTER (o < 3) AS b,
         string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, o) AS spans,
         count(*) FILTER (owners < 3) AS n_live, count(*) FILTER (owners >= 3) AS n_example
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN a USING (r)
"""

# Phrases and statements of the license scan.
_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
_STATEMENTS = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
)
#: Which labels the words of a block allow, told by regular expressions on the block's text.
_ALLOWED = (
    ("mit", " (mit license|hereby granted free of charge) "),
    ("apache-2", " apache license version 2 "),
    ("cc-by", " by 4 "),
    ("cc-by-nc", " by nc 4 "),
    ("cc-by-sa", " by sa 4 "),
    ("cc-by-nd", " by nd 4 "),
    ("cc-by-nc-sa", " by nc sa 4 "),
    ("cc-by-nc-nd", " by nc nd 4 "),
    ("gpl-3", " general public license version 3 "),
    ("gpl-2", " general public license version 2 "),
    ("mpl-2", " mozilla public license version 2 "),
    ("bsd", " source and binary forms "),
    ("all-rights-reserved", " all rights reserved "),
)


def _values(pairs: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"({k}, string_split('{text}', ' '), '{label}')" for k, (text, label) in enumerate(pairs))


LICENSES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_plain_words("text")} AS w FROM documents
), ph(n, p, label) AS (
  VALUES {_values(_PHRASES)}
), tp(n, t, label) AS (
  VALUES {_values(_STATEMENTS)}
), allowed_by(label, pattern) AS (
  VALUES {", ".join(f"('{label}', '{pattern}')" for label, pattern in _ALLOWED)}
), occ AS (
  SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d
), base AS (
  SELECT r, i - 1 AS pos, label FROM occ JOIN ph ON w[i] = p[1] AND w[i:i + len(p) - 1] = p
), b AS (
  SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS ls FROM base GROUP BY r
), blocks AS (
  SELECT r, w[s + 1:s + 20] AS x FROM (SELECT r, w, unnest(range(0, greatest(len(w), 1), 10)) AS s FROM d)
), pairs AS (
  SELECT r, label, len(list_intersect(list_distinct(t), list_distinct(x))) AS shared, len(list_distinct(t)) AS n,
         regexp_matches(' ' || array_to_string(x, ' ') || ' ', pattern) AS allowed
  FROM blocks, tp JOIN allowed_by USING (label)
), held AS (
  SELECT * FROM pairs WHERE allowed AND 100 * shared >= 85 * n
), m AS (
  SELECT r, list(DISTINCT label) AS ls, max(shared / n) AS share, count(*) AS n_blocks FROM held GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(b.ls, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), coalesce(m.ls, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score, coalesce(n_blocks, 0)::BIGINT AS n_blocks
FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""

NEAR_COPIES = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), {_A_Z}), '{SPACES}'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r
), links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)
), reach AS (
  SELECT r, r AS t FROM d
  UNION
  SELECT reach.r, links.y FROM reach JOIN links ON reach.t = links.x
), least AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM d JOIN least USING (r) LEFT JOIN n USING (r)
"""

RESAMPLING = r"""
WITH remainders AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) AS r(i)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark
), dw AS (
  SELECT r, unnest(w) AS w FROM d
), vocabulary AS (
  SELECT w, hex(w) AS h FROM (SELECT w FROM dw UNION SELECT w FROM b)
), hashed AS (
  SELECT w, xor(list_reduce(list_transform(range(strlen(w)), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM vocabulary, remainders
), own AS (
  SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY bucket
), wanted AS (
  SELECT bucket, count(*) AS n FROM b JOIN hashed USING (w) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM dw) AS s, (SELECT count(*) FROM b) AS t
), gains AS (
  SELECT own.bucket, CAST(floor(1000 * ln(((coalesce(wanted.n, 0) + 1.0::DOUBLE) * (s + 10000.0::DOUBLE))
    / ((own.n + 1.0::DOUBLE) * (t + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM totals, own LEFT JOIN wanted USING (bucket)
), weights AS (
  SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r
), scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
