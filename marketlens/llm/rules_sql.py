"""The quality rules as SQL for DuckDB: the base counts, the votes and every round of the fit."""

from __future__ import annotations

from marketlens.llm.rules import MIN_WORDS, ROUNDS, RULES, START_PRIOR, START_RATE, STRENGTH, SYMBOLS

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _without(chars: str) -> str:
    return f"length(translate(t, {chars}, ''))"


def _measures() -> str:
    return f"""
    src AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
    cut AS MATERIALIZED (
        SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w,
            list_filter(string_split(t, chr(10)), lambda x: translate(x, {_BLANK}, '') <> '') AS l FROM src),
    win AS (
        SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3)),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM win) WHERE n > 1),
    cov AS (SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) AS o(d) GROUP BY r),
    meas AS MATERIALIZED (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({_without(_BLANK)} AS BIGINT) AS word_chars,
            CAST(length(t) - {_without(f"'{SYMBOLS}'")} AS BIGINT) AS n_symbols,
            CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
            coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) - {_without("'!'")} AS n_exclaim,
            length(t) - {_without("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")} AS n_upper,
            len(list_filter(w, lambda x: translate(x, '{SYMBOLS}!', '') <> x)) AS n_odd
        FROM cut LEFT JOIN cov USING (r))"""


def _votes() -> str:
    out = []
    for rule, (measure, good, bad) in RULES.items():
        top, under = measure.split(" / ")
        x = f"({top}) / CAST(nullif({under}, 0) AS DOUBLE)"
        yes = "" if good is None else f"WHEN {x} < {good} THEN 1 "
        out.append(f"CASE {yes}WHEN {x} > {bad} THEN 0 END AS v_{rule}")
    return "voted AS MATERIALIZED (SELECT *, " + ", ".join(out) + " FROM meas)"


def _posterior() -> str:
    good = " * ".join(["prior", *(f"CASE v_{r} WHEN 1 THEN a_{r} WHEN 0 THEN 1 - a_{r} ELSE 1 END" for r in RULES)])
    bad = " * ".join(["(1 - prior)", *(f"CASE v_{r} WHEN 1 THEN 1 - a_{r} WHEN 0 THEN a_{r} ELSE 1 END" for r in RULES)])
    return f"({good}) / (({good}) + ({bad}))"


def sql() -> str:
    names = ", ".join(f"v_{r}" for r in RULES)
    start = ", ".join(f"CAST({START_RATE} AS DOUBLE) AS a_{r}" for r in RULES)
    rates = ", ".join(
        f"(sum(n * CASE v_{r} WHEN 1 THEN p WHEN 0 THEN 1 - p ELSE 0 END) + {START_RATE * STRENGTH}) "
        f"/ (sum(CASE WHEN v_{r} IS NULL THEN 0 ELSE n END) + {STRENGTH}) AS a_{r}"
        for r in RULES
    )
    rounds = [f"fit0 AS (SELECT {start}, CAST({START_PRIOR} AS DOUBLE) AS prior)"]
    for k in range(ROUNDS):
        rounds.append(
            f"fit{k + 1} AS MATERIALIZED (SELECT {rates}, (sum(n * p) + {START_PRIOR * STRENGTH}) / (sum(n) + {STRENGTH}) AS prior "
            f"FROM (SELECT pats.*, {_posterior()} AS p FROM pats, fit{k}))"
        )
    return f"""WITH {_measures()}, {_votes()},
    pats AS MATERIALIZED (SELECT {names}, count(*) AS n FROM voted WHERE n_words >= {MIN_WORDS} GROUP BY ALL),
    {", ".join(rounds)}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND p_good >= 0.5 AS kept, round(p_good, 6) AS p_good
    FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {_posterior()} AS p_good
          FROM voted, fit{ROUNDS})"""
