"""The source mix as SQL for DuckDB: cells, flattened targets, every round of raking, the draw."""

from __future__ import annotations

from marketlens.llm.mixing import BUDGET, CLIP_ROUNDS, MARGINS, POWER, ROUNDS, TOPICS


def _topic() -> str:
    cases = "".join(
        " WHEN " + " OR ".join(f"contains(lower(text), '{cue}')" for cue in cues) + f" THEN '{name}'" for name, cues in TOPICS.items()
    )
    return f"CASE WHEN NOT regexp_matches(coalesce(text, ''), '[^ \\x09-\\x0D]') THEN 'none'{cases} ELSE 'prose' END"


def sql() -> str:
    parts = [
        f"""base AS MATERIALIZED (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, {_topic()} AS topic,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS BIGINT) AS tokens,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 AS draw FROM documents)""",
        "cells AS MATERIALIZED (SELECT s AS source, l AS lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM base GROUP BY ALL)",
        "whole AS MATERIALIZED (SELECT sum(tokens) AS total FROM cells)",
    ]
    for m in MARGINS:
        parts.append(
            f"aim_{m} AS MATERIALIZED (SELECT v, x / sum(x) OVER () AS share FROM (SELECT {m} AS v, pow(sum(tokens), {POWER}) AS x "
            f"FROM cells GROUP BY {m} HAVING sum(tokens) > 0))"
        )
    last = "r0"
    parts.append("r0 AS (SELECT *, tokens AS raked FROM cells)")
    for k in range(ROUNDS):
        for m in MARGINS:
            name = f"r{k + 1}_{m}"
            parts.append(
                f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, coalesce(raked * share * total / nullif(now, 0), 0) AS raked "
                f"FROM (SELECT *, sum(raked) OVER (PARTITION BY {m}) AS now FROM {last}) LEFT JOIN aim_{m} ON v = {m}, whole)"
            )
            last = name
    parts.append(f"rated AS MATERIALIZED (SELECT *, raked / tokens AS weight FROM {last} WHERE tokens > 0)")
    parts.append("c0 AS (SELECT CAST(0 AS DOUBLE) AS c)")
    for k in range(CLIP_ROUNDS):
        parts.append(
            f"c{k + 1} AS MATERIALIZED (SELECT coalesce(({BUDGET} * any_value(total) - coalesce(sum(tokens) FILTER (weight * c >= 1), 0)) "
            f"/ nullif(coalesce(sum(raked) FILTER (weight * c < 1), 0), 0), any_value(c)) AS c FROM rated, whole, c{k})"
        )
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, b.source, b.lang, b.topic, b.tokens,
        round(CASE WHEN b.tokens > 0 THEN weight ELSE 0 END, 6) AS weight,
        round(CASE WHEN b.tokens > 0 THEN least(1.0, weight * c) ELSE 0 END, 6) AS probability,
        b.tokens > 0 AND coalesce(draw < least(1.0, weight * c), false) AS sampled
    FROM base b LEFT JOIN rated r ON r.source = b.s AND r.lang = b.l AND r.topic = b.topic, c{CLIP_ROUNDS}"""
