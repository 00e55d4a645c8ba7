"""Personal data in texts: fixed patterns, and what stands in the same contexts. DataFrame only.

The fixed patterns give e-mail addresses, IP addresses, card and phone numbers. These seed a
bootstrapping search. Identifier-like tokens, valid matches among them, are instances; the words
around an instance are its lexical patterns. Patterns and instances form a graph on which
confidence is passed back and forth: a pattern is worth the confidence of the instances it occurs
with, smoothed by its support, and an instance is worth what its patterns make likely together.
After some rounds, tokens in patterns of high confidence that no fixed pattern matches are reported
as spans of the kind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sitetext.operators.joins import lookup
from sitetext.plans.staging import Staging

KINDS = ("email", "ip", "card", "phone")
#: Rounds, smoothing of a pattern's support, seeds a pattern needs, and least confidence.
ROUNDS, SMOOTHING, MIN_SEEDS, MIN_CONFIDENCE = 3, 2.0, 3, 0.6
#: Characters on either side that may hold context words.
CONTEXT_CHARS = 60

# A match can begin where the last one ended, or where a run of its first characters begins: a
# later start in the same run fails as the first does. Possessive repeats need no way back.
_FIRST = r"(?:\G|(?<![{0}]))"
_EMAIL_CHARS, _TOKEN_CHARS = r"A-Za-z0-9._%+-", r"A-Za-z0-9@._%+#/-"
PATTERNS = {
    "email": _FIRST.format(_EMAIL_CHARS)
    + rf"[{_EMAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _FIRST.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": _FIRST.format(_TOKEN_CHARS)
    + rf"(?=[A-Za-z._%+#/-]*+[0-9@])[{_TOKEN_CHARS}]{{5,}}+",
}
_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"

_DIGITS = "regexp_replace(value, '[^0-9]', '')"
_LUHN = (
    f"aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) -> "
    "if(i % 2 = 0, CAST(d AS INT), CAST(substring('0246813579', CAST(d AS INT) + 1, 1) AS INT))), "
    "0, (a, x) -> a + x) % 10 = 0"
)
_VALID = f"""CASE kind
  WHEN 'ip' THEN forall(split(value, '[.]'),
    x -> length(TRIM(LEADING '0' FROM x)) <= 3 AND CAST(concat('0', right(x, 3)) AS INT) <= 255)
  WHEN 'card' THEN length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}
  WHEN 'phone' THEN length({_DIGITS}) BETWEEN 9 AND 15
  ELSE true END"""


def all_matches(docs: DataFrame) -> DataFrame:
    """Every match of every pattern: row, kind, start, end, value, left and right context.

    `docs` has a key `row` per row and its text. Start and end count code points.
    """
    clean = docs.withColumn("text", F.translate("text", _OPEN + _CLOSE, _OTHER * 2))
    kinds = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.split(
                    F.regexp_replace("text", f"({PATTERNS[kind]})", f"{_OPEN}$1{_CLOSE}"), _OPEN
                ).alias("parts"),
            )
            for kind in PATTERNS
        )
    )
    cut = (
        clean.select("row", F.explode(kinds).alias("k"))
        .where("size(k.parts) > 1")
        .select("row", "k.kind", "k.parts")
    )
    gap = f"substring_index({{}}, '{_CLOSE}', -1)"
    # Context reaches over other matches of the kind. Each part has at least two characters and one
    # mark, so this many parts hold all characters of it, and of a part no more are needed than:
    parts, chars = CONTEXT_CHARS // 2, CONTEXT_CHARS + 1
    joined = f"translate(array_join(transform(slice(parts, {{}}), x -> {{}}(x, {chars})), ''), '{_CLOSE}', '')"
    before = joined.format(f"greatest(i - {parts}, 0) + 1, least(i, {parts})", "right")
    behind = joined.format(f"i + 2, {parts}", "left")
    # A part takes its context along before it becomes a row, so rows don't grow with the text.
    fields = {
        "i": "i",
        "value": f"if(i = 0, '', substring_index(part, '{_CLOSE}', 1))",
        "gap": f"length({gap.format('part')})",
        "left_text": f"if(i = 0, '', right({before}, {CONTEXT_CHARS}))",
        "right_text": f"left(concat(left({gap.format('part')}, {CONTEXT_CHARS}), {behind}), {CONTEXT_CHARS})",
    }
    struct = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    rows = cut.selectExpr(
        "row", "kind", f"inline(transform(parts, (part, i) -> named_struct({struct})))"
    )
    # Equal rows share their key: every i comes once per copy, and the frame takes in its equals.
    along = "OVER (PARTITION BY row, kind ORDER BY i)"
    copies = "sum(if(i = 0, 1, 0)) OVER (PARTITION BY row, kind)"
    return (
        rows.selectExpr(
            "*",
            f"sum(length(value) + gap) {along} DIV {copies} - gap AS end",
            "length(value) AS size",
        )
        .where("i > 0")
        .selectExpr("row", "kind", "end - size AS start", "end", "value", "left_text", "right_text")
    )


def _with_patterns(matches: DataFrame) -> DataFrame:
    """Adds the lexical patterns of each match: the two words before, and a word on each side."""
    word = "regexp_replace(lower({}), '[0-9]', '0')"
    return matches.selectExpr(
        "*",
        word.format("regexp_extract(left_text, '([^\\\\s]{1,30}\\\\s+[^\\\\s]{1,30})\\\\s*$', 1)") + " AS two",
        word.format("regexp_extract(left_text, '([^\\\\s]{1,30})\\\\s*$', 1)") + " AS one",
        word.format("regexp_extract(right_text, '^\\\\s*([^\\\\s]{1,30})', 1)") + " AS after",
    ).selectExpr(
        "row", "kind", "start", "end", "value", "valid",
        "filter(array(if(two <> '', concat('b ', two), NULL), "
        "if(one <> '' AND after <> '', concat('s ', one, ' _ ', after), NULL)), p -> p IS NOT NULL) AS patterns",
    )


def _free_tokens(matches: DataFrame) -> DataFrame:
    """Tokens that overlap no valid match of a fixed pattern."""
    base = "CASE WHEN kind <> 'token' THEN {} END"
    before = "OVER (PARTITION BY row ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    up, down = before.format("start, end, kind"), before.format("start DESC, end DESC, kind DESC")
    covered = (
        f"coalesce(max({base.format('end')}) {up}, 0) > start "
        f"OR coalesce(min({base.format('start')}) {down}, end) < end"
    )
    marked = matches.selectExpr("*", f"{covered} AS covered")
    return marked.where("kind = 'token' AND NOT covered").drop("covered")


def score_patterns(
    seeds: DataFrame, tokens: DataFrame, staging: Staging, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """Confidence of patterns (kind, pattern, seeds, confidence) and of token values (kind, value,
    confidence), passed over the graph of patterns and instances `rounds` times."""
    seeded = staging.stage(
        seeds.select("kind", "value", F.explode("patterns").alias("pattern")).distinct(), "seed_edges"
    )
    unknown = staging.stage(
        tokens.select("value", F.explode("patterns").alias("pattern")).distinct(), "token_edges"
    )
    support = seeded.groupBy("kind", "pattern").agg(F.count("*").alias("seeds"))
    # Only patterns that occur with a seed can carry confidence.
    support = staging.stage(support, "support")
    per_pattern = unknown.groupBy("pattern").agg(F.count("*").alias("others"))
    sizes = staging.stage(
        seeded.groupBy("pattern").agg(F.countDistinct("value").alias("all_seeds"))
        .join(per_pattern, "pattern", "left")
        .selectExpr("pattern", "all_seeds + coalesce(others, 0) AS instances"),
        "sizes",
    )
    n_unknown = unknown.count()
    believed, patterns = None, None
    for turn in range(1, rounds + 1):
        gained = support.join(sizes, "pattern")
        if believed is not None:
            more = (
                unknown.join(believed, "value")
                .groupBy("kind", "pattern")
                .agg(F.sum("confidence").alias("more"))
            )
            gained = gained.join(more, ["kind", "pattern"], "left")
        else:
            gained = gained.withColumn("more", F.lit(0.0))
        patterns = staging.stage(
            gained.selectExpr(
                "kind",
                "pattern",
                "seeds",
                f"(seeds + coalesce(more, 0)) / (instances + {SMOOTHING}) AS confidence",
            ),
            f"patterns_{turn}",
        )
        by_pattern = patterns.groupBy("pattern").agg(
            F.collect_list(F.struct("kind", "confidence")).alias("of")
        )
        believed = staging.stage(
            lookup(unknown, by_pattern, ["pattern"], "value", n_unknown)
            .where("of IS NOT NULL")
            .select("value", F.inline("of"))
            .groupBy("kind", "value")
            .agg(F.expr("1 - exp(sum(ln(1 - least(confidence, 0.999))))").alias("confidence")),
            f"believed_{turn}",
        )
    return patterns, believed


def personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per document: doc_id and its spans (rank, kind, start, end).

    Kinds email, ip, card and phone are valid matches of the fixed patterns; ctx_email and so on are
    tokens found by context. Start and end count code points, the end is exclusive. Spans come in
    the order of rank and start. A null or empty text has no spans. Repeated rows give equal
    results and count once as evidence, a null doc_id stays null, an empty table gives none. Other
    columns are not read.
    """
    staging = Staging(docs.sparkSession)
    source = docs.selectExpr(
        f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"coalesce(`{text_col}`, '') AS text"
    ).selectExpr("doc_id", "struct(coalesce(doc_id, 0) AS a, xxhash64(doc_id IS NULL, text) AS b) AS row", "text")
    matches = staging.stage(
        _with_patterns(
            all_matches(source.select("row", "text")).withColumn("valid", F.expr(_VALID)).where("valid")
        ).distinct(),
        "matches",
    )
    tokens = staging.stage(_free_tokens(matches), "tokens")
    seeds = matches.where("kind <> 'token'")
    patterns, believed = score_patterns(seeds, tokens, staging)
    strong = patterns.where(f"confidence >= {min_confidence} AND seeds >= {min_seeds}").select(
        "pattern", F.col("kind").alias("found")
    )
    trusted = believed.where(f"confidence >= {min_confidence}").select("value", F.col("kind").alias("found"))
    discovered = (
        tokens.select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
        .join(strong, "pattern")
        .join(trusted, ["value", "found"])
        .selectExpr("row", "concat('ctx_', found) AS kind", "start", "end")
        .distinct()
    )
    order = reduce(
        lambda e, k: e.when(F.col("kind") == k[1], k[0]),
        enumerate([*KINDS, *(f"ctx_{k}" for k in KINDS)]),
        F.when(F.lit(False), -1),
    )
    spans = (
        seeds.select("row", "kind", "start", "end")
        .unionByName(discovered)
        .withColumn("rank", order)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "start", "end", "kind"))).alias("spans"))
    )
    return (
        source.select("doc_id", "row")
        .join(spans, "row", "left")
        .selectExpr("doc_id", "coalesce(spans, array()) AS spans")
    )
