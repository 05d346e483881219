"""The same results in DuckDB's SQL, where SQL expresses an operator."""

from __future__ import annotations

from clicktide.llm import ngram_join, pii, quality_rules as qr

_BLANKS = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(string_split_regex(t, '{_BLANKS}'), lambda w: w <> '')"
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"

# What a match must pass, and the patterns without what only keeps Java's matcher fast.
_VALID = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda p: TRY_CAST(p AS HUGEINT) <= 255))",
    "card": f"""length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(
        range(length({_DIGITS})), lambda k: CAST(reverse({_DIGITS})[k + 1] AS INT) * (1 + k % 2)
            - CASE WHEN k % 2 = 1 AND reverse({_DIGITS})[k + 1] > '4' THEN 9 ELSE 0 END)) % 10 = 0""",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": """length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0::HUGEINT,
        list_transform(range(length(replace(v, ' ', ''))),
            lambda k: ascii((replace(v, ' ', '')[5:] || replace(v, ' ', '')[:4])[k + 1])::HUGEINT)),
        lambda r, c: CASE WHEN c >= 65 THEN (r * 100 + c - 55) % 97 ELSE (r * 10 + c - 48) % 97 END) = 1""",
    "ssn": "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND v[:3] NOT IN ('000', '666') "
    "AND v[1] <> '9' AND v[5:6] <> '00' AND v[8:] <> '0000'",
    "local_phone": r"regexp_full_match(v, '(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}')",
}
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "local_phone": r"[+(]?[0-9]+(?:[ ().-]{1,3}[0-9]+)*",
}


def _kind_sql(kind: pii.Kind) -> str:
    """Lists of the spans as 'kind:start:end' and of their scores in percent, per document."""
    pattern = _PATTERNS.get(kind.name, kind.pattern.replace("++", "+"))
    start = (
        "list_sum(list_transform(parts[:i], lambda p: length(p)))"
        " + coalesce(list_sum(list_transform(vals[:i - 1], lambda p: length(p))), 0)"
    )
    near = (
        f"lower(right(left(t, CAST({start} AS BIGINT)), {pii.CONTEXT_CHARS}) || ' ' || "
        f"left(substr(t, CAST({start} AS BIGINT) + length(vals[i]) + 1), {pii.CONTEXT_CHARS}))"
    )
    score = (
        f"CASE WHEN regexp_matches({near}, '{kind.context}') THEN {round(100 * kind.raised)} "
        f"WHEN regexp_matches({near}, '{kind.against}') THEN {round(100 * kind.lowered)} "
        f"ELSE {round(100 * kind.score)} END"
    )
    valid = _VALID[kind.name].replace("(v", "(vals[i]").replace(" v[", " vals[i][").replace("v,", "vals[i],")
    return f"""
    SELECT row_id, list_transform(found, lambda f: f.span) AS {kind.name},
           list_transform(found, lambda f: f.score) AS {kind.name}_scores
    FROM (SELECT row_id, list_filter(list_transform(list_filter(range(1, len(vals) + 1), lambda i: {valid}),
              lambda i: {{'span': '{kind.name}:' || CAST({start} AS BIGINT) || ':'
                                  || CAST({start} + length(vals[i]) AS BIGINT),
                          'score': {score}}}),
              lambda f: f.score >= {round(100 * kind.least)}) AS found
          FROM (SELECT row_id, t, string_split_regex(t, '{pattern}') AS parts,
                       regexp_extract_all(t, '{pattern}') AS vals FROM d))"""


def pii_sql() -> str:
    names = [kind.name for kind in pii.KINDS]
    found = " ".join(f"JOIN ({_kind_sql(kind)}) USING (row_id)" for kind in pii.KINDS)
    counts = ", ".join(f"CAST(len({n}) AS BIGINT) AS n_{n}" for n in pii.BASE_KINDS)
    base = f"list_concat({', '.join(pii.BASE_KINDS)})"
    every = f"list_concat({', '.join(names)})"
    scores = f"list_concat({', '.join(f'{n}_scores' for n in names)})"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, {counts}, sha256(array_to_string({base}, ',')) AS base_sha256,
           array_to_string({every}, ',') AS spans, array_to_string({scores}, ',') AS scores
    FROM d {found}"""


def quality_sql() -> str:
    """Exact quartiles in place of sketches, which are as exact for groups of a few hundred."""
    sides = [(m, side) for m in qr.MEASURES for side in ("low", "high") if getattr(m, side)]

    def bounds(suffix: str) -> str:
        return ", ".join(
            f"quantile_disc({m.name}, {0.25 if side == 'low' else 0.75}) {'-' if side == 'low' else '+'} {qr.SPREADS} * "
            f"greatest(quantile_disc({m.name}, 0.75) - quantile_disc({m.name}, 0.25), {m.least}) "
            f"AS {side}_{m.name}_{suffix}"
            for m, side in sides
        )

    def bound(name: str) -> str:
        return (
            f"CASE WHEN n_own >= {qr.MIN_GROUP} THEN {name}_own WHEN n_lang >= {qr.MIN_GROUP} THEN {name}_lang "
            f"ELSE {name}_all END"
        )

    within = " AND ".join(
        f"coalesce({m.name} {'>=' if side == 'low' else '<='} {bound(f'{side}_{m.name}')}, true)"
        for m, side in sides
    )
    rate = "CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0::DOUBLE END AS {n}"
    rates = ", ".join(
        rate.format(a=a, b=b, n=n)
        for a, b, n in (
            ("n_symbols", "word_chars", "symbols_per_char"), ("n_dup_lines", "n_lines", "dup_lines_per_line"),
            ("n_repeat_words", "n_words", "repeats_per_word"), ("word_chars", "n_words", "chars_per_word"),
        )
    )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    w AS (SELECT row_id, {_WORDS} AS words FROM d),
    places AS (SELECT row_id, i, array_to_string(words[i:i + 4], ' ') AS win
               FROM (SELECT row_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) > 4)),
    often AS (SELECT row_id, i FROM places QUALIFY count(*) OVER (PARTITION BY row_id, win) > 1),
    covered AS (SELECT row_id, count(DISTINCT i + k) AS n FROM often, range(5) r(k) GROUP BY row_id),
    base AS (
        SELECT d.row_id, doc_id, lang, source, len(words)::BIGINT AS n_words,
               length(regexp_replace(t, '{_BLANKS}', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
               (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
               coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
        FROM (SELECT *, list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d) d
        JOIN w USING (row_id) LEFT JOIN covered USING (row_id)),
    m AS (SELECT *, n_words < {qr.MIN_WORDS} OR 100 * n_repeat_words > {qr.MAX_REPEAT_PERCENT} * n_words AS base_failed,
                 {rates} FROM base),
    own AS (SELECT lang, source, count(*) AS n_own, {bounds('own')} FROM m WHERE NOT base_failed GROUP BY ALL),
    by_lang AS (SELECT lang, count(*) AS n_lang, {bounds('lang')} FROM m WHERE NOT base_failed GROUP BY ALL),
    of_all AS (SELECT {bounds('all')} FROM m WHERE NOT base_failed)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {within} AS kept, {', '.join(x.name for x in qr.MEASURES)}
    FROM m LEFT JOIN own ON m.lang IS NOT DISTINCT FROM own.lang AND m.source IS NOT DISTINCT FROM own.source
    LEFT JOIN by_lang ON m.lang IS NOT DISTINCT FROM by_lang.lang, of_all"""


def ngram_join_sql() -> str:
    n = ngram_join.WORDS
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = _WORDS.replace("(t,", f"(translate(coalesce(text, ''), '{upper}', '{lower}'),")
    return f"""
    WITH RECURSIVE w AS (SELECT doc_id, {words} AS words FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
              range(1, greatest(len(words) - {n - 1}, 1) + 1),
              lambda i: array_to_string(words[i:i + {n - 1}], ' '))) END AS shingles FROM w),
    g AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS gram FROM s),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram
              GROUP BY a.doc_id, b.doc_id, a.n, b.n
              HAVING 100 * count(*) >= {ngram_join.THRESHOLD_PERCENT} * (a.n + b.n - count(*))),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM s
              UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id
    FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id"""


ORACLE_SQL = {
    "op1_pii": pii_sql(),
    "op2_quality_rules": quality_sql(),
    "op4_ngram_join": ngram_join_sql(),
}
