"""Keyword rules over long word lists: one pass over a text, whatever the number of words."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from silverline.functions.text import blank_to_null, safe_lower

#: An automaton has at most one state a character, some 100 bytes each.
MAX_CHARS = 1_000_000


def _by_word(rules: dict[str, list[str]]) -> dict[str, tuple[str, ...]]:
    owners: dict[str, tuple[str, ...]] = {}
    for name, words in rules.items():
        for word in dict.fromkeys(words):
            owners[word] = (*owners.get(word, ()), name)
    return owners


def automaton(owners: dict[str, tuple[str, ...]]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for word, names in owners.items():
        built.add_word(word, names)
    built.make_automaton()
    return built


def tag_texts(df: DataFrame, column: str, rules: dict[str, list[str]], into: str) -> DataFrame:
    """`keyword_tags` for rules of thousands of words: `|`-joined names of the rules with a word in the text.

    All rules become one Aho-Corasick automaton, built once a task from a broadcast of the words, so
    time follows the text and its hits. Names are in order; null, empty and unmatched texts give
    null; words match inside longer words, as there. Rules with more than `MAX_CHARS` characters are
    refused, as the automaton has to fit beside the task.
    """
    owners = _by_word(rules)
    if sum(map(len, owners)) > MAX_CHARS:
        raise ValueError(f"Keyword rules have more than {MAX_CHARS} characters")
    always = owners.pop("", ())
    shared = df.sparkSession.sparkContext.broadcast(owners)

    @F.arrow_udf("string")
    def tags(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = automaton(shared.value) if shared.value else None

        def names(text: str) -> str:
            hits = set(always)
            if found and text:
                for _, names_of_word in found.iter(text):
                    hits.update(names_of_word)
            return "|".join(sorted(hits))

        for texts in batches:
            yield pa.array((names(text.as_py()) for text in texts), pa.string())  # one text at a time as an object

    return df.withColumn(into, blank_to_null(tags(safe_lower(column))))
