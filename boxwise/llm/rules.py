"""Quality rules: one threshold table compiled into one Spark projection.

The statistics are column expressions over the whole text (no user functions)
and the verdict is a conjunction built from ``THRESHOLDS``.  Ratios are
compared cross-multiplied as integers, so every engine decides alike.

Defined results: a null or empty text has no words and fails the base rule;
repeated rows are judged one by one; an empty table gives an empty result;
extra input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WS = r"[\\x20\\x09-\\x0D]"
NON_WS = r"[^\\x20\\x09-\\x0D]"

# Frequent function words of the corpus languages.
STOP_WORDS = ("the of and to in is that it for as with le la les de des et un une en que der die das "
              "und den von mit ist nicht el los las y del por con para se su").split()


@dataclass(frozen=True)
class Rule:
    """Keep only texts with ``lower * den <= 100 * num <= upper * den`` (percent bounds)."""
    name: str
    num: str
    den: str
    lower: int | None = None
    upper: int | None = None

    def sql(self) -> str:
        parts = []
        if self.lower is not None:
            parts.append(f"100 * {self.num} >= {self.lower} * {self.den}")
        if self.upper is not None:
            parts.append(f"100 * {self.num} <= {self.upper} * {self.den}")
        return "(" + " AND ".join(parts) + ")"


THRESHOLDS = (
    Rule("length", "n_words", "1", lower=1_000),                      # ten words at least
    Rule("mean_word_length", "word_chars", "n_words", lower=200, upper=1_200),
    Rule("symbols_per_word", "n_symbols", "n_words", upper=20),
    Rule("shouting", "n_marks", "n_words", upper=50),                 # '!' and '?' per word
    Rule("stop_words", "n_stop_words", "n_words", lower=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", upper=30),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", upper=30),
)

BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"


def statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per-row statistics the rules read; one narrow projection chain, no shuffle."""
    t = df.select(F.col(f"`{id_col}`").alias("doc_id"),
                  F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    t = t.selectExpr(
        "doc_id", "t",
        f"filter(split(t, '{WS}+', -1), w -> w <> '') AS words",
        f"filter(split(t, '\\n', -1), l -> l RLIKE '{NON_WS}') AS lines")
    t = t.selectExpr(
        "doc_id", "t", "words", "lines",
        "CASE WHEN size(words) >= 5 THEN transform(sequence(0, size(words) - 5), i -> "
        "xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) "
        "ELSE array() END AS windows")
    # texts without a repeated window (nearly all) never sort their windows
    t = t.selectExpr(
        "doc_id", "t", "words", "lines",
        "CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
        "array_sort(transform(windows, (h, i) -> struct(h AS h, i AS i))) "
        "ELSE cast(array() AS array<struct<h:bigint,i:int>>) END AS ranked")
    t = t.selectExpr(
        "doc_id", "t", "words", "lines",
        "array_sort(transform(filter(ranked, (x, k) -> "
        "(k > 0 AND ranked[k - 1].h = x.h) OR (k < size(ranked) - 1 AND ranked[k + 1].h = x.h)), x -> x.i)) AS hit")
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return t.selectExpr(
        "doc_id",
        "cast(size(words) AS bigint) AS n_words",
        "cast(length(array_join(words, '')) AS bigint) AS word_chars",
        "cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '')) AS bigint) AS n_symbols",
        "cast(size(lines) - size(array_distinct(lines)) AS bigint) AS n_dup_lines",
        # a repeated window at hit[k] covers five words, less what the next one covers
        "cast(aggregate(transform(hit, (p, k) -> least(5, coalesce(get(hit, k + 1), p + 5) - p)), 0, "
        "(a, x) -> a + x) AS bigint) AS n_repeat_words",
        "cast(length(t) - length(regexp_replace(t, '[!?]+', '')) AS bigint) AS n_marks",
        f"cast(size(filter(words, w -> lower(w) IN ({stop}))) AS bigint) AS n_stop_words",
        "cast(size(lines) AS bigint) AS n_lines",
        "cast(size(filter(lines, l -> l LIKE '%...' OR l LIKE '%…')) AS bigint) AS n_ellipsis_lines")


def apply_rules(df: DataFrame, rules=THRESHOLDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, ``base_failed``, the names of failed rules, and ``kept``."""
    failed = ", ".join(f"CASE WHEN NOT {r.sql()} THEN '{r.name}' END" for r in rules)
    return (statistics(df, id_col=id_col, text_col=text_col)
            .selectExpr("*", f"{BASE_FAILED} AS base_failed",
                        f"concat_ws(',', {failed}) AS failed_rules")
            .selectExpr("*", "NOT base_failed AND failed_rules = '' AS kept"))


def rules_oracle(rules=THRESHOLDS) -> str:
    """The same statistics and verdicts as DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    nw = r"[^\x20\x09-\x0D]"
    failed = ", ".join(f"CASE WHEN NOT {r.sql()} THEN '{r.name}' END" for r in rules)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{nw}+') AS words,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{nw}')) AS lines FROM d),
win AS (SELECT rid, i, list_aggregate(words[i:i+4], 'string_agg', ' ') AS g
        FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
s AS (SELECT w.doc_id, cast(len(words) AS BIGINT) AS n_words,
  cast(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  cast(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  cast(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
  cast(len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
  cast(len(lines) AS BIGINT) AS n_lines,
  cast(len(list_filter(lines, lambda l: ends_with(l, '...') OR ends_with(l, '…'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN rep ON w.rid = rep.rid),
v AS (SELECT *, {BASE_FAILED} AS base_failed, concat_ws(',', {failed}) AS failed_rules FROM s)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM v"""
