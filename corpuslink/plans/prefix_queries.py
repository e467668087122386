"""Registered prefix dictionary queries: words of the documents, typed by the other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.functions.text import NEARBY_KEYS, word_tokens
from corpuslink.operators import prefix
from corpuslink.plans import views
from corpuslink.plans.views import with_views
from corpuslink.session import cut_lineage, shared_folder
from corpuslink.streaming import prefix_stream, typing


def dictionary_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_doc = F.expr(f"line_no div {views.WORDS_PER_DOCUMENT}")
    return views.words(spark, sf_dir).select("word", first_doc.alias("first_doc"))


def prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_index(views.words(spark, sf_dir)).select("prefix", "n_words", "is_word")


def prefix_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = prefix.keystrokes(views.benchmark_words(spark, sf_dir))
    return prefix.completions(views.stored_words(spark, sf_dir), typed)


def prefix_completions_ref_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = prefix.keystrokes(views.benchmark_words(spark, sf_dir))
    return prefix.ordered_completions(views.stored_words(spark, sf_dir), typed).select(
        "prefix", "suffix", "position"
    )


def prefix_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = prefix.keystrokes(views.benchmark_words(spark, sf_dir))
    return prefix.decide(typed, views.stored_words(spark, sf_dir)).select(
        "prefix", "n", "status", F.array_join("candidates", " ").alias("candidates"), "resolved_word"
    )


def word_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.membership(views.spoken_words(spark, sf_dir), views.words(spark, sf_dir))


def accepted_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.texts(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return prefix.accepted_messages(lines, views.words(spark, sf_dir), ["conv_id", "turn"])


def keyboard_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix.keyboard_suggestions(views.spoken_words(spark, sf_dir), views.words(spark, sf_dir))
    return found.select("word", F.array_join("suggestions", " ").alias("suggestions"))


def keyboard_suggestions_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix.keyboard_suggestions_two(views.spoken_words(spark, sf_dir), views.words(spark, sf_dir))
    return found.select("word", F.array_join("suggestions", " ").alias("suggestions"))


def prefix_stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every keystroke of the benchmark texts as a stream, looked up in the stored decisions."""
    texts = prefix_stream.stream_table(spark, f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    typed = texts.select("item_id", F.explode(word_tokens(F.col("text"))).alias("word")).select(
        "item_id",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda n: F.left(F.col("word"), n))
        ).alias("prefix"),
    )
    decisions = prefix.decision_table(
        views.stored_words(spark, sf_dir), prefix.keystrokes(views.benchmark_words(spark, sf_dir))
    )
    seen = prefix_stream.run_available(prefix_stream.decide_stream(typed, cut_lineage(decisions)))
    return seen.groupBy("item_id", "prefix", "n", "status").agg(F.count("*").alias("n_typed"))


#: Characters of a piece of typed input.
PIECE_CHARS = 32


def typed_messages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations typed piece by piece; the message of its known words."""
    turns = prefix_stream.stream_table(spark, f"{sf_dir}/conversations.parquet")
    pieces = turns.select("conv_id", "turn", F.posexplode(typing.pieces_of(F.col("text"), PIECE_CHARS)).alias("seq", "chars"))
    found = typing.typed_messages(
        pieces, views.stored_words(spark, sf_dir), ["conv_id", "turn"], shared_folder(spark, "typing")
    )
    return found.select("conv_id", "turn", "message", "n_unknown")


QUERIES = {
    "dictionary_words": dictionary_words,
    "prefix_counts": prefix_counts,
    "prefix_completions": prefix_completions,
    "prefix_completions_ref_order": prefix_completions_ref_order,
    "prefix_decisions": prefix_decisions,
    "word_membership": word_membership,
    "accepted_message": accepted_message,
    "keyboard_suggestions": keyboard_suggestions,
    "keyboard_suggestions_two": keyboard_suggestions_two,
    "prefix_stream_lookup": prefix_stream_lookup,
    "typed_messages_stream": typed_messages_stream,
}

# tree order of the words below a prefix, told by the first line of every longer prefix
_ORDER_KEYS = """firsts AS MATERIALIZED (
    SELECT prefix, min(line_no) AS first_line FROM word_prefixes GROUP BY prefix),
keyed AS MATERIALIZED (
    SELECT p.word, list(lpad(CAST(f.first_line * 2 AS VARCHAR), 12, '0') ORDER BY p.len) AS firsts,
           list(CASE WHEN p.len < length(p.word) THEN '1' ELSE '0' END ORDER BY p.len) AS inner_flags
    FROM word_prefixes p JOIN firsts f ON p.prefix = f.prefix WHERE p.len > 0 GROUP BY p.word),
steps AS MATERIALIZED (
    SELECT word, list_transform(range(1, length(word) + 1), lambda i: inner_flags[i] || firsts[i]) AS steps
    FROM keyed),
ranked AS MATERIALIZED (
    SELECT k.prefix, p.word, substr(p.word, length(k.prefix) + 1) AS suffix,
           row_number() OVER (PARTITION BY k.prefix ORDER BY list_slice(s.steps, length(k.prefix) + 1,
                              length(p.word))) - 1 AS position
    FROM keystrokes k JOIN word_prefixes p ON k.prefix = p.prefix JOIN steps s ON p.word = s.word)"""

_KEYS = ", ".join(
    f"('{key}', '{neighbour}')" for key, row in NEARBY_KEYS.items() for neighbour in row
)

_MESSAGES = with_views(
    ("words",),
    """SELECT t.conv_id, t.turn, coalesce(string_agg(w.word, ' ' ORDER BY t.pos), '') AS message,
              count(t.token) - count(w.word) AS n_unknown
       FROM tokens t LEFT JOIN words w ON t.token = w.word GROUP BY t.conv_id, t.turn""",
    """found AS (SELECT conv_id, turn, regexp_extract_all(text, '[a-zA-Z][a-zA-Z0-9]*') AS toks
                 FROM conversations),
       spread AS (SELECT conv_id, turn, toks, unnest(range(1, greatest(len(toks), 1) + 1)) AS pos FROM found),
       tokens AS (SELECT conv_id, turn, pos, toks[pos] AS token FROM spread)""",
)

SQL = {
    "prefix_stream_lookup": with_views(
        ("word_prefixes",),
        """SELECT t.item_id, t.prefix, coalesce(p.n, 0) AS n,
                  CASE WHEN p.n IS NULL THEN 'misspelled' WHEN p.n = 1 THEN 'accepted'
                       WHEN p.n <= 10 THEN 'list' ELSE 'count_only' END AS status, count(*) AS n_typed
           FROM typed t LEFT JOIN counts p ON t.prefix = p.prefix GROUP BY ALL""",
        """counts AS MATERIALIZED (SELECT prefix, count(*) AS n FROM word_prefixes GROUP BY prefix),
           said AS (SELECT item_id, unnest(regexp_extract_all(text, '[a-zA-Z][a-zA-Z0-9]*')) AS word FROM benchmark),
           typed AS (SELECT item_id, left(word, CAST(len AS INTEGER)) AS prefix
                     FROM (SELECT item_id, word, unnest(range(1, length(word) + 1)) AS len FROM said))""",
    ),
    "dictionary_words": with_views(
        ("word_places",), "SELECT toks[pos] AS word, min(doc_id) AS first_doc FROM word_places GROUP BY 1"
    ),
    "prefix_counts": with_views(
        ("word_prefixes",),
        """SELECT prefix, count(*) AS n_words, bool_or(prefix = word) AS is_word
           FROM word_prefixes GROUP BY prefix""",
    ),
    "prefix_completions": with_views(
        ("word_prefixes", "keystrokes"),
        """SELECT k.prefix, p.word, substr(p.word, length(k.prefix) + 1) AS suffix
           FROM keystrokes k JOIN word_prefixes p ON k.prefix = p.prefix""",
    ),
    "prefix_completions_ref_order": with_views(
        ("word_prefixes", "keystrokes"), "SELECT prefix, suffix, position FROM ranked", _ORDER_KEYS
    ),
    "prefix_decisions": with_views(
        ("word_prefixes", "keystrokes"),
        """SELECT k.prefix, count(r.word) AS n,
                  CASE WHEN count(r.word) = 0 THEN 'misspelled' WHEN count(r.word) = 1 THEN 'accepted'
                       WHEN count(r.word) <= 10 THEN 'list' ELSE 'count_only' END AS status,
                  CASE WHEN count(r.word) BETWEEN 2 AND 10
                       THEN string_agg(r.word, ' ' ORDER BY r.position) END AS candidates,
                  CASE WHEN count(r.word) = 1 THEN max(r.word) END AS resolved_word
           FROM keystrokes k LEFT JOIN ranked r ON k.prefix = r.prefix GROUP BY k.prefix""",
        _ORDER_KEYS,
    ),
    "word_membership": with_views(
        ("words", "spoken_words"),
        "SELECT word, word IN (SELECT word FROM words) AS is_word FROM spoken_words",
    ),
    "accepted_message": _MESSAGES,
    "typed_messages_stream": _MESSAGES,
    "keyboard_suggestions": with_views(
        ("words", "spoken_words"),
        """SELECT word, string_agg(suggestion, ' ' ORDER BY suggestion) AS suggestions
           FROM (SELECT DISTINCT word, suggestion FROM variants)
           WHERE suggestion IN (SELECT word FROM words) GROUP BY word HAVING count(*) <= 20""",
        f"""nearby(letter, neighbour) AS (VALUES {_KEYS}),
            letters AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM spoken_words),
            variants AS (SELECT word, substr(word, 1, i - 1) || neighbour || substr(word, i + 1) AS suggestion
                         FROM letters JOIN nearby ON substr(word, i, 1) = letter)""",
    ),
    "keyboard_suggestions_two": with_views(
        ("words", "spoken_words"),
        """SELECT word, string_agg(suggestion, ' ' ORDER BY suggestion) AS suggestions
           FROM (SELECT word, suggestion FROM apart GROUP BY word, suggestion
                 HAVING count(*) BETWEEN 1 AND 2 AND count(*) = count(letter))
           GROUP BY word HAVING count(*) <= 20""",
        f"""nearby(letter, neighbour) AS (VALUES {_KEYS}),
            close AS MATERIALIZED (
                SELECT t.word, w.word AS suggestion FROM spoken_words t JOIN words w
                ON length(t.word) = length(w.word) AND t.word <> w.word AND hamming(t.word, w.word) <= 2),
            places AS (SELECT word, suggestion, unnest(range(1, length(word) + 1)) AS i FROM close),
            apart AS (SELECT p.word, p.suggestion, n.letter FROM places p
                      LEFT JOIN nearby n ON n.letter = substr(p.word, i, 1) AND n.neighbour = substr(p.suggestion, i, 1)
                      WHERE substr(p.word, i, 1) <> substr(p.suggestion, i, 1))""",
    ),
}
