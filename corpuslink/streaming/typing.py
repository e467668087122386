"""Typing sessions: characters in, words and messages out, as a stream with state.

A session's input comes in numbered pieces of one or more characters. For every micro-batch the words
that end in it are read off, per session: letters and digits go on with the open word, a backspace
takes its last character away, anything else ends it, and control-D starts the message anew. The
words are looked up in the dictionary by a join, and the message of the known words, how many were
unknown, and whether the last one was go on from there.

Pieces carry numbers, so a piece that comes twice counts once and one that comes early waits in the
state until those before it are there; the result does not depend on how the input falls into
micro-batches. Words and states are written below one folder, a folder per micro-batch, and a stream
started again with it goes on where it stopped. The state of a session is its open word, its message
and what waits. All sessions of a micro-batch are worked on as rows of columns: a call into Python
for each of them costs more than its work.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.operators.prefix import membership
from corpuslink.session import discard, list_folders

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A token as the batch functions read it: a letter, then letters or digits of any script.
_TOKEN = r"[a-zA-Z][a-zA-Z\d]*"
# What control-D and the backspace key send.
RESET = "\x04"
BACKSPACE = "\x7f"
#: After so many micro-batches the last states of all sessions are written as a base.
COMPACT_EVERY = 16
_READ = "expected bigint, word string, waiting_seq array<bigint>, waiting_chars array<string>"
_SAID = "message string, n_unknown bigint, misspelled boolean"


def pieces_of(text: Column, size: int) -> Column:
    """A text and the line end that closes it, as an array of pieces of ``size`` characters."""
    return F.regexp_extract_all(F.concat(F.coalesce(text, F.lit("")), F.lit("\n")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def _taken(numbers: Sequence[int], values: Sequence, expected: int) -> tuple[list, int, dict]:
    """Values whose numbers follow each other from ``expected`` on, the next number, and what still
    waits."""
    held: dict = {}
    for n, value in zip(numbers, values):
        if n >= expected:
            held.setdefault(n, value)
    ready = []
    while expected in held:
        ready.append(held.pop(expected))
        expected += 1
    return ready, expected, held


def read_piece(word: str, piece: str) -> tuple[list[str | None], str]:
    """Words that end inside a piece (``None``: the message starts anew) and the word left open."""
    out: list[str | None] = []
    for run in re.split(f"([{RESET}{BACKSPACE}])", piece):
        if run == RESET:
            out.append(None)
            word = ""
        elif run == BACKSPACE:
            word = word[:-1]
        elif run:
            tokens = re.findall(_TOKEN, word + run)
            word = tokens.pop() if tokens and (word + run).endswith(tokens[-1]) else ""
            out += tokens
    return out, word


def _read_sessions(numbers: pd.Series, chars: pd.Series, expected: pd.Series, word: pd.Series) -> pd.DataFrame:
    """The words that end in the pieces of each session, and what it has read then."""
    rows = []
    for n, c, at, open_word in zip(numbers, chars, expected, word):
        ready, at, rest = _taken(n.tolist(), c, at)
        words, open_word = read_piece(open_word, "".join([x or "" for x in ready]))
        early = sorted(rest)
        rows.append((at, open_word, early, [rest[x] for x in early], words))
    return pd.DataFrame(rows, columns=["expected", "word", "waiting_seq", "waiting_chars", "words"])


def _same_session(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def ended_words(pieces: DataFrame, states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per session that has new ``pieces`` (``(*keys, seq, chars)``; ``seq`` counts a session's pieces
    from 0) its ``states`` row after them, the message still the old one, and the ``words`` that ended
    (a null one: the message starts anew)."""
    held = F.sort_array(F.collect_list(F.struct(F.col("seq").cast("long").alias("seq"), "chars")))
    new = pieces.groupBy(*keys).agg(held.alias("pieces"))
    old = states.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in states.columns if c not in keys])
    waits = lambda name: F.coalesce(F.col(f"waiting_{name}"), F.array())
    read = F.pandas_udf(_read_sessions, f"{_READ}, words array<string>")(
        F.concat("pieces.seq", waits("seq")),
        F.concat("pieces.chars", waits("chars")),
        F.coalesce("expected", F.lit(0).cast("long")),
        F.coalesce("word", F.lit("")),
    )
    said = [F.coalesce("message", F.lit("")), F.coalesce("n_unknown", F.lit(0).cast("long")), F.coalesce("misspelled", F.lit(False))]
    names = ("message", "n_unknown", "misspelled")
    return (
        new.join(old, _same_session(keys), "left")
        .select(*keys, read.alias("read"), *[c.alias(n) for c, n in zip(said, names)])
        .select(*keys, "read.*", *names)
    )


def messages(read: DataFrame, words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of the sessions after their ``words`` have been looked up in the dictionary."""
    typed = read.select(*keys, F.posexplode("words").alias("pos", "word"))
    checked = membership(typed, words).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.sort_array(F.collect_list(F.struct("pos", "word", "is_word"))).alias("checked")
    )
    every = F.coalesce(F.col("checked"), F.expr("array()"))
    anew = F.coalesce(F.array_max(F.transform(F.filter(every, lambda w: w["word"].isNull()), lambda w: w["pos"])), F.lit(-1))
    rows = read.join(checked, _same_session(keys), "left").withColumn("anew", anew)
    rows = rows.withColumn("later", F.filter(F.col("checked"), lambda w: w["pos"] > F.col("anew")))
    goes_on = F.col("anew") < 0
    accepted = F.transform(F.filter("later", lambda w: w["is_word"]), lambda w: w["word"])
    before = F.when(goes_on & (F.col("message") != ""), F.array("message")).otherwise(F.array().cast("array<string>"))
    nothing = F.col("checked").isNull()
    return rows.select(
        *keys,
        *[c.split()[0] for c in _READ.split(", ")],
        F.when(nothing, F.col("message")).otherwise(F.array_join(F.concat(before, accepted), " ")).alias("message"),
        F.when(nothing, F.col("n_unknown"))
        .otherwise(F.when(goes_on, F.col("n_unknown")).otherwise(0) + F.size(F.filter("later", lambda w: ~w["is_word"])))
        .cast("long").alias("n_unknown"),
        F.when(F.size("later") > 0, ~F.element_at("later", -1)["is_word"])
        .otherwise(goes_on & F.col("misspelled")).alias("misspelled"),
    )


class _States:
    """Last state of every session: a folder of changed states per micro-batch, and after every
    ``COMPACT_EVERY`` of them a base that stands for all up to its number."""

    def __init__(self, spark: SparkSession, folder: str, keys: str) -> None:
        self.spark, self.folder, self.schema = spark, folder, f"{keys}, {_READ}, {_SAID}"
        self.keys = [k.split()[0].strip("`") for k in keys.split(", ")]

    def _complete(self, kind: str) -> list[int]:
        names = list_folders(self.spark, self.folder, done=True)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))

    def base(self) -> int:
        """Number of the last micro-batch in the newest base, -1 if there is none."""
        return max(self._complete("base"), default=-1)

    def before(self, batch: int | None = None) -> DataFrame:
        """States as they were before a micro-batch (or are now)."""
        base = self.base()
        found = [(b, f"batch={b}") for b in self._complete("batch") if b > base and (batch is None or b < batch)]
        found += [(base, f"base={base}")] if base >= 0 else []
        if not found:
            empty = T.StructType.fromDDL(self.schema)
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in empty])
        parts = [
            self.spark.read.schema(self.schema).parquet(f"{self.folder}/{name}").withColumn("_batch", F.lit(b)) for b, name in found
        ]
        if len(parts) == 1:
            return parts[0].drop("_batch")
        others = [c for c in parts[0].columns if c not in (*self.keys, "_batch")]
        last = F.max_by(F.struct(*others), "_batch").alias("last")
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(last).select(*self.keys, "last.*")

    def add(self, states: DataFrame, batch: int) -> None:
        states.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        if (batch + 1) % COMPACT_EVERY == 0:
            base = self.base()
            self.before().write.mode("overwrite").parquet(f"{self.folder}/base={batch}")
            for old in self._complete("batch"):
                discard(self.spark, f"{self.folder}/batch={old}")
            if base >= 0:
                discard(self.spark, f"{self.folder}/base={base}")


def typed_messages(pieces: DataFrame, words: DataFrame, keys: Sequence[str], folder: str) -> DataFrame:
    """Run the stream over the input that is there now and return each session's message:
    ``(*keys, message, n_unknown, misspelled)``. ``words`` should be a stored dictionary."""
    spark = pieces.sparkSession
    chosen = pieces.select(*keys, "seq", "chars")
    states = _States(spark, f"{folder}/messages", ", ".join(f"`{k}` {t}" for k, t in chosen.select(*keys).dtypes))

    def fold(batch: DataFrame, number: int) -> None:
        if number <= states.base():
            return
        read = ended_words(batch, states.before(number), keys)
        read.write.mode("overwrite").parquet(f"{folder}/words/batch={number}")
        stored = spark.read.schema(read.schema).parquet(f"{folder}/words/batch={number}")
        states.add(messages(stored, words, keys), number)

    query = (
        chosen.writeStream.foreachBatch(fold)
        .option("checkpointLocation", f"{folder}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return states.before().select(*keys, "message", "n_unknown", "misspelled")
