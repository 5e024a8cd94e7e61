"""Quality rules as weak supervision. DataFrame operations only.

Every rule votes good (1) or bad (-1) or abstains (0). How often a rule is right about good and about
bad documents is not known; expectation-maximisation estimates it, with the share of good documents,
from how the votes of all documents agree. Documents are folded to their vote patterns first: there
are at most 3 ** rules of them, whatever the data, and each iteration is one aggregate over that
table giving one row. The posterior probability of being good replaces all-must-pass filtering.

A rule may be weak but not perverse: a good vote never counts against a document, a bad one never for it.

Cases: a null text has no words; a text without words fails the base; a null doc_id stays null;
repeated rows are judged, and counted, each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise

# Fixed values of the base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

ITERATIONS = 25
_SPACE = " \\t\\n\\x0B\\f\\r"
_SPACE_CHARS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PRIOR = (0.05, 0.95)
_RATE = (0.05, 0.999)
_SMOOTHING = 1.0
_START = {"pi": 0.8, "a": 0.9, "b": 0.5}

# Votes by rule, as SQL that Spark and DuckDB read alike: (bad when, good when) over the metrics of a text with words.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("word_chars < 2.0 * n_words OR word_chars > 20.0 * n_words", "word_chars BETWEEN 2.5 * n_words AND 14.0 * n_words"),
    "symbols": ("n_symbols > 0.08 * n_words", "n_symbols < 0.02 * n_words"),
    "symbol_share": ("n_symbols > 0.05 * word_chars", "n_symbols < 0.01 * word_chars"),
    "lines": ("n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    "repeats": ("n_repeat_words > 0.25 * n_words", "n_repeat_words < 0.1 * n_words"),
    "capitals": ("n_upper > 0.3 * word_chars", "n_upper < 0.1 * word_chars"),
    "shouting": ("n_exclaim > 0.1 * n_words", "n_exclaim < 0.02 * n_words"),
    "digits": ("n_digits > 0.3 * word_chars", "n_digits < 0.1 * word_chars"),
    "length": ("n_words < 50", "n_words >= 100"),
}


def metrics(docs: DataFrame) -> DataFrame:
    """Counts per document; ``n_repeat_words`` comes from sorting the hashes of a text's 3-word windows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_SPACE}]+"))

    def count_of(chars: str) -> Column:
        return (F.length("text") - F.length(F.translate("text", chars, ""))).cast("long")

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("words", words)
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{_SPACE}]"))
    last = F.size("words") - 3
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("hash"), i.alias("at")
            ),
        ),
    ).otherwise(F.array().cast("array<struct<hash:bigint,at:int>>"))
    counted = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _SPACE_CHARS, "")).cast("long").alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        count_of(_UPPER).alias("n_upper"),
        count_of("!").alias("n_exclaim"),
        count_of("0123456789").alias("n_digits"),
        lines.alias("lines"),
        F.sort_array(windows).alias("windows"),
    )

    def repeated(window: Column, k: Column) -> Column:
        same = [F.get("windows", at)["hash"] == window["hash"] for at in (k - 1, k + 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    found = F.transform(F.filter("windows", repeated), lambda w: F.array(w["at"], w["at"] + 1, w["at"] + 2))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(found))).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_upper", "n_exclaim", "n_digits",
    )


BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


def _votes() -> dict[str, str]:
    return {
        f"v{j}": f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"
        for j, (bad, good) in enumerate(RULES.values())
    }


def log_odds(parameter) -> str:
    """Log odds of a vote pattern; ``parameter`` gives the SQL of pi, aj (right about good) and bj (right about bad)."""
    terms = [f"ln({parameter('pi')} / (1 - {parameter('pi')}))"]
    for j in range(len(RULES)):
        a, b = parameter(f"a{j}"), parameter(f"b{j}")
        terms.append(f"CASE v{j} WHEN 1 THEN ln({a} / (1 - {b})) WHEN -1 THEN ln((1 - {a}) / {b}) ELSE 0 END")
    return "(" + " + ".join(terms) + ")"


def _clamped(value: str, low: str | float, high: float) -> str:
    return f"least(greatest({value}, {low}), {high})"


def maximisation() -> dict[str, str]:
    """Parameters from patterns (v0.., n) with the posterior p: sums first, then rates."""
    sums = {"all_n": "sum(CAST(n AS DOUBLE))", "good": "sum(n * p)"}
    for j in range(len(RULES)):
        sums |= {
            f"ga{j}": f"sum(CASE WHEN v{j} = 1 THEN n * p ELSE 0 END)", f"gt{j}": f"sum(CASE WHEN v{j} <> 0 THEN n * p ELSE 0 END)",
            f"ba{j}": f"sum(CASE WHEN v{j} = -1 THEN n * (1 - p) ELSE 0 END)", f"bt{j}": f"sum(CASE WHEN v{j} <> 0 THEN n * (1 - p) ELSE 0 END)",
        }
    return sums


def rates() -> dict[str, str]:
    out = {"pi": _clamped("good / all_n", *_PRIOR)}
    for j in range(len(RULES)):
        right_good = _clamped(f"(ga{j} + {_SMOOTHING}) / (gt{j} + {2 * _SMOOTHING})", *_RATE)
        right_bad = f"(ba{j} + {_SMOOTHING}) / (bt{j} + {2 * _SMOOTHING})"
        out[f"a{j}"] = right_good
        # A rule may not be perverse: its bad votes hit bad documents at least as often as good ones.
        out[f"b{j}"] = _clamped(right_bad, f"greatest({_RATE[0]}, 1 - {right_good})", _RATE[1])
    return out


def start() -> dict[str, float]:
    return {"pi": _START["pi"]} | {f"{k}{j}": _START[k] for j in range(len(RULES)) for k in ("a", "b")}


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def estimate(patterns: DataFrame, iterations: int = ITERATIONS) -> dict[str, float]:
    """Parameters after the given number of iterations; each brings one row to the driver."""
    values = start()
    sums, formulas = maximisation(), rates()
    for _ in range(iterations):
        odds = log_odds(lambda name, now=values: _double(now[name]))
        row = (
            patterns.withColumn("p", F.expr(f"1 / (1 + exp(-{odds}))"))
            .agg(*[F.expr(sql).alias(name) for name, sql in sums.items()])
            .select(*[F.expr(sql).alias(name) for name, sql in formulas.items()])
            .first()
        )
        if row["pi"] is None:  # no documents
            return values
        values = row.asDict()
    return values


def judge(docs: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """Metrics, base_failed, votes, posterior and kept for each document."""
    voted = materialise(metrics(docs).withColumns({name: F.expr(sql) for name, sql in _votes().items()}), "votes")
    names = list(_votes())
    # At most 3 ** rules rows.
    patterns = materialise(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    values = estimate(patterns, iterations)
    odds = log_odds(lambda name: _double(values[name]))
    return voted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("posterior", F.expr(f"1 / (1 + exp(-{odds}))")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(store.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("posterior", 4).alias("posterior"),
    )


def op3_sql() -> str:
    space = "[\\x20\\x09-\\x0D]"
    names = list(_votes())
    steps = [f"i0 AS (SELECT {', '.join(f'CAST({v} AS DOUBLE) AS {k}' for k, v in start().items())})"]
    for i in range(1, ITERATIONS + 1):
        odds = log_odds(lambda name: name)
        steps.append(
            f"s{i} AS MATERIALIZED (SELECT {', '.join(f'{sql} AS {name}' for name, sql in maximisation().items())} FROM (SELECT pat.*, 1 / (1 + exp(-{odds})) AS p FROM pat, i{i - 1}))"
        )
        steps.append(f"i{i} AS MATERIALIZED (SELECT {', '.join(f'{sql} AS {name}' for name, sql in rates().items())} FROM s{i})")
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '{space}+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
tri AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM tri QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2),
cov AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + unnest([0, 1, 2]) AS at FROM rep) GROUP BY rid),
m AS (SELECT rid, doc_id, CAST(len(words) AS BIGINT) AS n_words, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaim, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits FROM w LEFT JOIN cov USING (rid)),
v AS MATERIALIZED (SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in _votes().items())} FROM m),
pat AS MATERIALIZED (SELECT {', '.join(names)}, count(*) AS n FROM v GROUP BY ALL),
{', '.join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
  NOT {BASE_FAILED} AND 1 / (1 + exp(-{log_odds(lambda name: name)})) >= 0.5 AS kept, round(1 / (1 + exp(-{log_odds(lambda name: name)})), 4) AS posterior
FROM v, i{ITERATIONS}
"""
