"""Many keywords at once: one Aho-Corasick automaton reads a text once, however many there are.

A keyword is a substring, as in the predicates. Few keywords stay built-in functions; the automaton is for lists that would make a
plan of thousands of terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW = 64
#: Characters of keywords that one automaton holds in a task; beyond that, actors are dealt to several, and texts are read once for each.
MOST_CHARACTERS = 8_000_000


class Automaton:
    """Numbers of the keywords that a text holds. The empty keyword is in every text; null keywords are in none."""

    def __init__(self, words: tuple[str | None, ...]):
        import ahocorasick

        self.trie, self.always = ahocorasick.Automaton(), []
        numbers: dict[str, list[int]] = {}
        for k, w in enumerate(words):
            if w == "":
                self.always.append(k)
            elif w is not None:
                numbers.setdefault(w, []).append(k)
        for w, own in numbers.items():
            self.trie.add_word(w, own)
        if numbers:
            self.trie.make_automaton()
        self.empty = not numbers

    def find(self, text: str) -> set[int]:
        found = set(self.always)
        if not self.empty:
            for _, own in self.trie.iter(text):
                found.update(own)
        return found

    def any(self, text: str) -> bool:
        return bool(self.always) or (not self.empty and next(self.trie.iter(text), None) is not None)


@lru_cache(4)
def automaton(words: tuple[str | None, ...]) -> Automaton:
    """One for each worker process."""
    return Automaton(words)


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether any of the words is a substring; an empty list matches nothing, a null text gives null."""
    if len(words) <= FEW:
        return reduce(or_, (F.contains(text, F.lit(w)) for w in words), F.lit(False))
    words = tuple(words)

    def held(texts: pa.Array) -> pa.Array:
        find = automaton(words).any
        return pa.array([None if t is None else find(t) for t in texts.to_pylist()], pa.bool_())

    held.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(held, "boolean")(text)


def matched_words(text: Column, words: list[str]) -> Column:
    """The words that are substrings, in the order of the list."""
    if len(words) <= FEW:
        return F.filter(F.array(*map(F.lit, words)).cast("array<string>"), lambda k: F.contains(text, k))
    words = tuple(words)

    def held(texts: pa.Array) -> pa.Array:
        find = automaton(words).find
        return pa.array([None if t is None else [words[k] for k in sorted(find(t))] for t in texts.to_pylist()], pa.list_(pa.string()))

    held.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(held, "array<string>")(text)


def actors_in(actors: DataFrame, texts: DataFrame, most_characters: int = MOST_CHARACTERS) -> DataFrame:
    """The rows of texts, without their text, once for each actor that has a keyword in it.

    actors: actor, keywords (array); rows of one actor are one actor. texts: keys, then `_hay`. Keywords go to the tasks in blocks of
    bounded size, all of an actor's in one block, so that no pair comes twice.
    """
    spark = texts.sparkSession
    own = actors.filter(F.size("keywords") > 0).select("actor", F.explode("keywords").alias("word")).filter("word IS NOT NULL")
    blocks = max(1, -(-(own.agg(F.sum(F.length("word") + 1)).first()[0] or 0) // most_characters))
    keys = [c for c in texts.columns if c != "_hay"]
    kind = own.schema["actor"].dataType.simpleString()
    schema = ", ".join([*(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keys), f"actor {kind}"])
    out = None
    for block in range(blocks):
        mine = own.filter(F.pmod(F.xxhash64("actor"), F.lit(blocks)) == block) if blocks > 1 else own
        held = spark.sparkContext.broadcast([tuple(r) for r in mine.collect()])  # some `most_characters` characters

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            names = [a for a, _ in held.value]
            machine = automaton(tuple(w for _, w in held.value))
            for batch in batches:
                rows, found = [], []
                for k, text in enumerate(batch.column(len(keys)).to_pylist()):
                    if text is not None and (hits := machine.find(text)):
                        who = sorted({names[n] for n in hits}, key=repr)
                        rows += [k] * len(who)
                        found += who
                at = pa.array(np.array(rows, np.int64))
                columns = [batch.column(c).take(at) for c in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _arrow(kind))], [*keys, "actor"])

        part = texts.select(*keys, "_hay").mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _arrow(kind: str) -> pa.DataType | None:
    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}.get(kind)
