"""Benchmark passages in documents, by a positional inverted index. DataFrame functions only.

The words of all documents are looked up among the words of the benchmark, which gives the number
of documents' places of each benchmark word. Each window of an item is then found from its two
rarest words: the index stores their postings (word, document, place), and lists shifted by the
words' offsets in the item are intersected. Postings of a window's rarest word also store the words
around the place, and on these the rest of the window is compared word by word.

The index holds rare words only, so it stays small against the text; words that are in no chosen
pair are counted and not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitetext.plans.staging import Staging

#: Words of a window.
WINDOW = 13
#: Words of a text that are posted together.
BLOCK = 32
#: Distance in words within which the two rarest words of an item count as near each other.
NEAR = 8
#: Up to so many rows of benchmark words are broadcast; more are joined by shuffling.
MAX_BROADCAST_WORDS = 500_000

# What stands between words, in texts with capitals, and a block of words.
_MARKS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_BETWEEN = rf"[{_MARKS}]+"
_BLOCK = rf"(?:[^{_MARKS}]++[{_MARKS}]*+){{1,{BLOCK}}}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(word: str) -> str:
    """A-Z in lower case. Slow for whole texts: it is applied to words that a join has found."""
    return f"translate({word}, '{_UPPER}', '{_LOWER}')"


def _with_words(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The words of a text, as they are written, as an array.

    Explode it as outer: else a filter on its size is put below, which splits the text again.
    """
    split = F.split(F.coalesce(F.col(text), F.lit("")), _BETWEEN)
    parts = df.select(*keep, split.alias("parts"))
    first = "if(parts[0] = '', 2, 1)"
    last = "if(size(parts) > 1 AND parts[size(parts) - 1] = '', size(parts) - 1, size(parts))"
    words = f"slice(parts, {first}, greatest({last} - {first} + 1, 0))"
    return parts.select(*keep, F.expr(words).alias("words"))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MAX_BROADCAST_WORDS else df


def _keyed(docs: DataFrame) -> DataFrame:
    """Keys of a document and its text; rows with equal id and text share their keys."""
    return docs.selectExpr(
        "coalesce(doc_id, 0) AS id_key", "xxhash64(doc_id IS NULL, text) AS text_key",
        "doc_id IS NULL AS no_id", "text",
    )


def word_counts(docs: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """How often each of the given words occurs in the documents, in whatever case.

    The count only ranks words, so those that differ in the case of letters beyond ASCII share it;
    `lower` is fast on whole tables.
    """
    places = _with_words(docs, "text", []).select(F.explode_outer("words").alias("word"))
    keys = words.selectExpr("lower(word) AS key").distinct()
    found = (
        places.selectExpr("lower(word) AS key")
        .join(_small(keys, n_words), "key")
        .groupBy("key")
        .agg(F.count("*").alias("n"))
    )
    return (
        words.withColumn("key", F.expr("lower(word)"))
        .join(found, "key", "left")
        .selectExpr("word", "coalesce(n, 0L) AS n")
    )


def window_pairs(items: DataFrame, counts: DataFrame, window: int, n_words: int) -> DataFrame:
    """The places of the two rarest words of each window: item_id, words, rarest, second.

    Windows of an item that share their pair are one row. An item of one word has it twice.
    """
    places = items.select("item_id", F.posexplode("words").alias("place", "word"))
    ranked = (
        places.join(_small(counts, n_words), "word")
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("ns"))
        .join(items, "item_id")
    )
    starts = f"sequence(0, greatest(size(words) - {window}, 0))"
    windows = ranked.select("item_id", "words", "ns", F.explode(F.expr(starts)).alias("start"))
    by_count = (
        f"array_sort(transform(slice(ns, start + 1, {window}), x -> struct(x.n AS n, x.place AS place)))"
    )
    return (
        windows.withColumn("best", F.expr(by_count))
        .selectExpr(
            "item_id",
            "words",
            "best[0].place AS rarest",
            "coalesce(get(best, 1).place, best[0].place) AS second",
        )
        .distinct()
    )


def build_index(docs: DataFrame, chosen: DataFrame, n_chosen: int, window: int) -> DataFrame:
    """Postings of the chosen words: word, keys of the document, place, and for words marked `full`
    the words around it and how many of them stand before.

    The empty word is posted at the place after the last word, so it holds a document's length.
    """
    reach = window - 1
    keys = ["id_key", "text_key", "no_id"]
    # Each word carries the few words of its block and of the blocks beside it, so what it carries
    # does not grow with the text. The empty block at the end stands for the empty word.
    blocks = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_BLOCK), F.lit(0))
    beside = (
        "inline_outer(transform(blocks, (x, k) -> named_struct('k', k, 'previous', "
        "coalesce(get(blocks, k - 1), ''), 'block', x, 'following', coalesce(get(blocks, k + 1), ''))))"
    )
    words_of = lambda c: F.array_remove(F.split(c, _BETWEEN), "")
    is_end = F.col("block") == ""
    places = (
        _keyed(docs)
        .select(*keys, F.concat(blocks, F.array(F.lit(""))).alias("blocks"))
        .selectExpr(*keys, beside)
        .select(
            *keys, "k", "previous", "block", "following",
            F.posexplode_outer(
                F.when(is_end, F.array(F.lit(""))).otherwise(words_of("block"))
            ).alias("i", "written"),
        )
    )
    place = F.when(~is_end, F.col("k") * BLOCK + F.col("i")).otherwise(
        F.when(F.col("k") == 0, 0).otherwise((F.col("k") - 1) * BLOCK + F.size(words_of("previous")))
    )
    before = f"least(place, {reach})"
    here = f"least(size(previous_words), {reach}) + i"
    near = f"concat(slice(previous_words, -least(size(previous_words), {reach}), {reach}), block_words, following_words)"
    near = f"if(size(previous_words) = 0, concat(block_words, following_words), {near})"
    around = f"slice(near, here - {before} + 1, {before} + {window})"
    found = (
        places.withColumn("key", F.expr("lower(written)"))
        .join(_small(chosen.withColumn("key", F.expr("lower(word)")), n_chosen), "key")
        .where(f"{_lowered('written')} = word")
        .withColumn("place", place)
    )
    sides = {f"{c}_words": F.when(F.col("full"), words_of(c)) for c in ("previous", "block", "following")}
    return (
        found.withColumns(sides)
        .withColumns({"here": F.expr(here), "near": F.expr(near)})
        .selectExpr(
            "word",
            "id_key",
            "text_key",
            "no_id",
            "place",
            f"CASE WHEN full THEN {before} END AS before",
            f"CASE WHEN full THEN transform({around}, w -> {_lowered('w')}) END AS around",
        )
    )


def phrase_matches(index: DataFrame, pairs: DataFrame, window: int, n_pairs: int) -> DataFrame:
    """Exact matches of whole windows: keys of the document, item_id, and the words from `start`
    to before `end` that match."""
    keys = ["id_key", "text_key", "item_id", "diagonal"]
    by_rarest = index.where("around IS NOT NULL").join(
        _small(
            pairs.selectExpr("element_at(words, rarest + 1) AS word", "item_id", "rarest", "second", "words"),
            n_pairs,
        ),
        "word",
    )
    firsts = by_rarest.selectExpr(
        "id_key", "text_key", "item_id", "place - rarest AS diagonal", "rarest", "second", "place",
        "before", "around", "words",
    )
    by_second = index.join(
        _small(
            pairs.selectExpr("element_at(words, second + 1) AS word", "item_id", "second").distinct(),
            n_pairs,
        ),
        "word",
    )
    seconds = by_second.selectExpr(
        "id_key", "text_key", "item_id", "place - second AS diagonal", "second"
    ).distinct()
    reach = window - 1
    left = f"least({reach}, rarest, before)"
    right = f"least({reach}, size(words) - 1 - rarest, size(around) - 1 - before)"
    same_left = (
        f"zip_with(reverse(slice(words, rarest - {left} + 1, {left})), "
        f"reverse(slice(around, before - {left} + 1, {left})), (x, y) -> x = y)"
    )
    same_right = (
        f"zip_with(slice(words, rarest + 2, {right}), slice(around, before + 2, {right}), "
        "(x, y) -> x = y)"
    )
    run = "if(array_position({0}, false) = 0, size({0}), array_position({0}, false) - 1)"
    return (
        firsts.join(seconds, [*keys, "second"], "left_semi")
        .selectExpr("*", f"{same_left} AS same_left", f"{same_right} AS same_right")
        .selectExpr(
            "id_key",
            "text_key",
            "item_id",
            f"place - {run.format('same_left')} AS start",
            f"place + {run.format('same_right')} + 1 AS end",
            f"least({window}, size(words)) AS needed",
        )
        .where("end - start >= needed")
        .drop("needed")
        .distinct()
    )


def proximity_matches(index: DataFrame, near: DataFrame, distance: int, n_near: int) -> DataFrame:
    """Items whose two given words stand at most `distance` words apart in a document, in either
    order: keys of the document and item_id. `near` has item_id, word_a and word_b."""
    cell = F.expr(f"CAST(floor(place / {distance}) AS bigint)")

    def postings(column: str) -> DataFrame:
        of = near.select("item_id", F.col(column).alias("word"))
        return index.join(_small(of, n_near), "word").select("item_id", "id_key", "text_key", "place")

    a = postings("word_a").select(
        "item_id", "id_key", "text_key", F.col("place").alias("a_place"), cell.alias("cell")
    )
    b = postings("word_b").select(
        "item_id", "id_key", "text_key", F.col("place").alias("b_place"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
    )
    return (
        a.join(b, ["item_id", "id_key", "text_key", "cell"])
        .where(f"abs(a_place - b_place) BETWEEN 1 AND {distance}")
        .select("id_key", "text_key", "item_id")
        .distinct()
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    near: int = NEAR,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, contaminated, n_near_items and
    text_key, a hash of the text that tells rows without doc_id apart.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower case. A word
    is hit if it lies in an occurrence of a window, which is `window` consecutive words of an item,
    or the whole of a shorter one. `items` are the ids, as sorted strings, of items with such
    windows; a document is contaminated if a twentieth of its words are hit. n_near_items counts
    items whose two rarest words stand at most `near` words apart.

    A null or empty text, or one without words, has no hits; items without words have no windows,
    and items without id are left out. Repeated rows get equal results, a null doc_id stays null
    and is judged by its text. An empty table gives none, an empty benchmark no hits. Other columns
    are not read.
    """
    staging = Staging(docs.sparkSession)
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    given = benchmark.selectExpr(f"CAST(`{item_col}` AS STRING) AS item", f"`{item_text_col}` AS text")
    # Texts, not ids, tell items apart inside, so that repeated ids keep all their texts.
    items = staging.stage(
        _with_words(
            given.where("item IS NOT NULL").selectExpr("struct(item, xxhash64(text) AS h) AS item_id", "text").distinct(),
            "text",
            ["item_id"],
        )
        .where("size(words) > 0")
        .selectExpr("item_id", f"transform(words, w -> {_lowered('w')}) AS words"),
        "items",
    )
    n_items, n_places = items.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    words = staging.stage(
        items.select(F.explode("words").alias("word")).distinct(), "words", n_places
    )
    n_words = words.count()
    counts = staging.stage(word_counts(source, words, n_words), "counts", n_words)
    pairs = staging.stage(window_pairs(items, counts, window, n_words), "pairs")
    n_pairs = pairs.count()
    rarest = (
        items.select("item_id", F.explode(F.array_distinct("words")).alias("word"))
        .join(_small(counts, n_words), "word")
        .groupBy("item_id")
        .agg(F.expr("slice(array_sort(collect_list(struct(n, word))), 1, 2)").alias("best"))
        .where("size(best) = 2")
        .selectExpr("item_id", "best[0].word AS word_a", "best[1].word AS word_b")
    )
    near_pairs = staging.stage(rarest, "near_pairs", n_items)
    posted = pairs.selectExpr("element_at(words, rarest + 1) AS word", "true AS full")
    for more in (
        pairs.selectExpr("element_at(words, second + 1) AS word"),
        near_pairs.select(F.explode(F.array("word_a", "word_b")).alias("word")),
        docs.sparkSession.sql("SELECT '' AS word"),
    ):
        posted = posted.unionByName(more.selectExpr("word", "false AS full"))
    chosen = staging.stage(
        posted.groupBy("word").agg(F.max("full").alias("full")), "chosen", n_words + 1
    )
    index = staging.stage(build_index(source, chosen, chosen.count(), window), "postings")
    matches = phrase_matches(index, pairs, window, n_pairs)
    keys = ["id_key", "text_key"]
    covered = (
        "greatest(0, end - greatest(start, coalesce(max(end) OVER (PARTITION BY id_key, text_key "
        "ORDER BY start, end, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))"
    )
    hits = (
        matches.withColumn("fresh", F.expr(covered))
        .groupBy(*keys)
        .agg(
            F.sum("fresh").cast("bigint").alias("n_hit"),
            F.array_sort(F.collect_set("item_id.item")).alias("items"),
        )
    )
    close = (
        proximity_matches(index, near_pairs, near, n_pairs)
        .groupBy(*keys)
        .agg(F.countDistinct("item_id.item").alias("n_near_items"))
    )
    sizes = index.where("word = ''").selectExpr(
        "id_key", "text_key", "no_id", "CAST(place AS bigint) AS n_words"
    )
    return (
        sizes.join(hits, keys, "left")
        .join(close, keys, "left")
        .selectExpr(
            "if(no_id, NULL, id_key) AS doc_id",
            "n_words",
            "coalesce(n_hit, 0L) AS n_hit",
            "CAST(coalesce(size(items), 0) AS bigint) AS n_items",
            "coalesce(items, array()) AS items",
            "coalesce(n_hit, 0L) > 0 AND 20 * coalesce(n_hit, 0L) >= n_words AS contaminated",
            "coalesce(n_near_items, 0L) AS n_near_items",
            "text_key",
        )
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, with all their columns, that are not contaminated."""
    bad = (
        contamination(docs, benchmark, id_col, text_col)
        .where("contaminated")
        .select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text"))
    )
    own_id = docs[id_col].cast("bigint")
    own_text = F.xxhash64(own_id.isNull(), docs[text_col])
    return docs.join(
        bad, own_id.eqNullSafe(bad["_bad_id"]) & (own_text == bad["_bad_text"]), "left_anti"
    )
