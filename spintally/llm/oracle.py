"""The queries of this subpackage as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from spintally.llm import decontamination, filter_audit, quality_rules
from spintally.llm.text import UPPER

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_LETTERED = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _quality_rules() -> str:
    rules = quality_rules
    spreads = " ".join(f"WHEN '{name}' THEN {least}" for name, least in rules.LEAST_SPREAD.items())
    within = " AND ".join(
        f"{name} <= coalesce((SELECT fence FROM limits l WHERE l.measure = '{name}'"
        " AND l.lang IS NOT DISTINCT FROM c.lang AND l.source IS NOT DISTINCT FROM c.source), "
        f"{name})"
        for name in rules.LEAST_SPREAD
    )
    return rf"""WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS body, {_SPACED} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM split, unnest(range(1, len(words) - 3)) AS r(i)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS s(k) GROUP BY doc_id
), c AS (
  SELECT s.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(body, '[^{rules.SYMBOLS}]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS letters_per_word,
    CASE WHEN len(lines) > 0 THEN 1000 * n_dup_lines // len(lines) ELSE 0 END AS repeated_lines
  FROM c
), values_ AS (
  SELECT lang, source, measure, value, CAST(pow(2, greatest(length(bin(value)) - {rules.SKETCH_BITS}, 0)) AS BIGINT) AS scale
  FROM (UNPIVOT (SELECT lang, source, CAST(symbols_per_word AS BIGINT) AS symbols_per_word,
      CAST(letters_per_word AS BIGINT) AS letters_per_word, CAST(repeated_lines AS BIGINT) AS repeated_lines
    FROM measured WHERE NOT base_failed)
    ON symbols_per_word, letters_per_word, repeated_lines INTO NAME measure VALUE value)
), buckets AS (
  SELECT lang, source, measure, value // scale * scale AS bucket FROM values_
), fences AS (
  SELECT level, lang, source, measure, n,
    high + {rules.FENCE} * greatest(high - low, CASE measure {spreads} END) AS fence
  FROM (
    SELECT grouping_id(lang, source) AS level, lang, source, measure, count(*) AS n,
      quantile_disc(bucket, 0.25) AS low, quantile_disc(bucket, 0.75) AS high
    FROM buckets GROUP BY GROUPING SETS ((lang, source, measure), (lang, measure), (measure))
  )
), limits AS (
  SELECT o.lang, o.source, o.measure,
    CASE WHEN o.n >= {rules.MIN_GROUP} THEN o.fence WHEN l.n >= {rules.MIN_GROUP} THEN l.fence ELSE a.fence END AS fence
  FROM fences o JOIN fences l ON l.level = 1 AND l.measure = o.measure AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN fences a ON a.level = 3 AND a.measure = o.measure WHERE o.level = 0
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND {within} AS kept
FROM measured c"""


def _substring_dedup() -> str:
    return f"""WITH split AS (
  SELECT doc_id, {_SPACED} AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS gram FROM split, unnest(range(1, len(words) - 18)) AS r(i)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1
), removed AS (
  SELECT DISTINCT doc_id, i + k AS place FROM later, unnest(range(0, 20)) AS s(k)
), each AS (
  SELECT doc_id, place, words[place] AS word FROM split, unnest(range(1, len(words) + 1)) AS r(place)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS rest FROM each ANTI JOIN removed USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)"""


def _decontamination() -> str:
    size = decontamination.WINDOW
    return f"""WITH docs AS (
  SELECT doc_id, {_LETTERED} AS words FROM documents
), items AS (
  SELECT item_id, {_LETTERED} AS words FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, least(len(words), {size}) AS n, array_to_string(words[i:i + {size - 1}], ' ') AS gram
  FROM items, unnest(range(1, greatest(len(words) - {size - 2}, 2))) AS r(i) WHERE len(words) > 0
), places AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM docs, (SELECT DISTINCT n FROM wanted) AS s, unnest(range(1, len(words) - n + 2)) AS r(i)
), found AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN wanted USING (gram)
), hits AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, n)) AS r(k) GROUP BY doc_id
), sources AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN sources USING (doc_id)"""


def _jaccard_join(width: int = 4, percent: int = 85) -> str:
    spaced = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"
    return f"""WITH RECURSIVE split AS (
  SELECT doc_id, {spaced} AS words FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {width - 1}], ' ') AS gram
  FROM split, unnest(range(1, greatest(len(words) - {width - 2}, 2))) AS r(i) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM grams a JOIN grams b USING (gram)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * shared >= {percent} * (s.n + t.n - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON a = other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM split JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def _filter_audit() -> str:
    audit = filter_audit
    letter = lambda at: f"substr(filter_order, {at}, 1)"
    fails = lambda which: f"(mask >> (ascii({which}) - 65)) & 1"
    earlier = " + ".join(f"CASE WHEN step > {at} THEN {fails(letter(at))} ELSE 0 END" for at in range(1, 5))
    total = lambda condition, what="n": f"CAST(coalesce(sum({what}) FILTER ({condition}), 0) AS BIGINT)"
    return rf"""WITH split AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, {_SPACED} AS words FROM documents
), tags AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CAST(len(words) < {audit.MIN_WORDS} AS INT)
    + 2 * CAST(100 * len(list_distinct(words)) < {audit.MIN_DISTINCT} * len(words) AS INT)
    + 4 * CAST(100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > {audit.MAX_CAPITALS} * length(body) AS INT)
    + 8 * CAST(regexp_matches(body, '{audit.SYMBOLS}') AS INT)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS INT) AS mask
  FROM split LEFT JOIN tags USING (doc_id)
), sets AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS one
), orders AS (
  SELECT a.one || b.one || c.one || d.one || e.one AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.one, b.one, c.one, d.one, e.one])) = 5
), states AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, n, good, toxic, mask = 1 << (ascii({letter("step")}) - 65) AS alone,
    {fails(letter("step"))} AS fails, {earlier} AS gone
  FROM sets, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps AS (
  SELECT part, filter_order, step, filter, {total("fails = 0 AND gone = 0")} AS kept, {total("fails = 1 AND gone = 0")} AS removed,
    {total("fails = 1 AND gone > 0")} AS redundant, {total("alone")} AS unique_fails,
    {total("fails = 1 AND gone = 0", "good")} AS good_lost, {total("fails = 1 AND gone = 0", "toxic")} AS toxic_lost
  FROM states GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM steps"""


def _exact_dedup() -> str:
    return r"""WITH own AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  n = first_value(n) OVER best AND doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER best AS kept, sha256(body) AS text_sha256
FROM own WINDOW best AS (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": _quality_rules(),
        "op4_substring_dedup": _substring_dedup(),
        "op5_benchmark_decontamination": _decontamination(),
        "op9_jaccard_join": _jaccard_join(),
        "op11_filter_audit": _filter_audit(),
        "op13_exact_dedup": _exact_dedup(),
    }
