"""Spelling variants by a dictionary of trie-node pairs (operator 11).

Two words are near if they differ by exactly one inserted, deleted or replaced code point.

1. One pass over the texts counts the runs of letters; a run whose checksum with the document's id is a
   multiple of ``EVERY`` loses one letter (the contract's planted misspellings).  Equal runs of a task are
   counted before the shuffle.
2. Words are numbered by falling count, then code-point order: the smallest number among some words is the
   one that a word takes as its form.
3. Every prefix of a word is a node of the forward trie, every suffix a node of the reversed trie.  Nodes of
   depth up to ``RADIX_DEPTH`` are numbered by their letters as digits; deeper ones by 127 bits of a BLAKE2b
   digest, so that long words cost one number a letter and no trie has to be held anywhere.
4. A word is entered under the node pair (prefix before i, suffix after i) for each skipped letter i, and
   under (prefix before i, suffix from i) for each place i.  Entries of one pair are words that differ in
   that one letter, and at most one word that lacks it.  A pair thus has at most one entry per letter of
   the alphabet (90) and one more, whatever the corpus, and no group grows with the data.
5. A letter inside a run of equal letters is skipped in several places with one result; only the skip at
   the run's first letter meets the shorter word, so each near word is counted once.
6. The form of a word is its near word of smallest number if that word's count is ``ratio`` times its own.
   Counts grow by that ratio along forms, so pointer doubling ends after the logarithm of a logarithm.
7. All tables of words are joined by sort and merge.  By the size of their files Spark takes them for small
   enough to broadcast: packed numbers need many times that in memory, and salted rows ``SALTS`` times more,
   all of it gathered on the driver.

Cases: null and empty texts hold no runs; a null id counts as empty text in the checksum; repeated rows
count each time; ties of count go to code-point order; no words give no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, store

#: Fixed values of the contract: a run of an ASCII-lower-cased text, and one run in this many loses a letter.
RUN = re.compile("[a-zÀ-ÿ]+")
EVERY = 199

ALPHABET = 26 + 64
RADIX_DEPTH = 9  # (ALPHABET + 1) ** 9 < 2 ** 63
FLUSH = 200_000  # distinct words held by a task
LONG = 1 << 22  # texts above this many characters are counted without a list of their runs
ROWS = 1 << 16  # node pairs of an output batch
SALTS = 16
PAIR = ["p1", "p2", "s1", "s2"]


def misspelled(run: str, checksum: int) -> str:
    if checksum % EVERY:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1:]


def _tally(min_length: int):
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([
                pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                text = (text.as_py() or "").encode().lower().decode()  # bytes: lowers A-Z only
                runs = Counter(RUN.findall(text) if len(text) < LONG else
                               (m[0] for m in RUN.finditer(text)))
                head = crc32(f"{name.as_py()}:".encode())
                for run, n in runs.items():
                    if len(run) >= min_length:
                        word = misspelled(run, crc32(run.encode(), head))
                        if len(word) >= min_length:
                            counts[word] += n
            if len(counts) > FLUSH:
                yield flushed()
        if counts:
            yield flushed()

    return tally


def words(docs: DataFrame, *, min_length: int = 6, min_count: int = 5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``word, n``: the words of all texts with at least so many letters and occurrences."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).alias("text"))
    return (rows.mapInArrow(_tally(min_length), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def trie_nodes(word: str) -> np.ndarray:
    """Numbers (two 64-bit integers each) of the nodes from the root to ``word``, one row per depth."""
    nodes = np.empty((len(word) + 1, 2), np.int64)
    number, digest = 0, blake2b(digest_size=16)
    nodes[0] = -1, 0
    for depth, letter in enumerate(word, 1):
        digest.update(letter.encode())
        if depth <= RADIX_DEPTH:
            code = ord(letter)
            number = number * (ALPHABET + 1) + (code - 96 if code < 128 else code - 0xC0 + 27)
            nodes[depth] = -1, number
        else:
            at = digest.copy().digest()
            nodes[depth] = (int.from_bytes(at[:8]) >> 1), int.from_bytes(at[8:], signed=True)
    return nodes


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node pairs of the words; ``role`` is 0 without a skip, 1 for a skip, 2 for a skip inside a run."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0

    def flushed() -> pa.RecordBatch:
        columns = [np.concatenate(parts) for parts in zip(*held)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*PAIR, "w", "role"])

    for batch in batches:
        for w, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n = len(word)
            prefix, suffix = trie_nodes(word), trie_nodes(word[::-1])[::-1]
            letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            repeated = np.zeros(n, bool)
            repeated[1:] = letters[1:] == letters[:-1]
            before = np.concatenate([prefix, prefix[:-1]])
            after = np.concatenate([suffix, suffix[1:]])
            role = np.concatenate([np.zeros(n + 1, np.int8), 1 + repeated.astype(np.int8)])
            held.append((before[:, 0], before[:, 1], after[:, 0], after[:, 1],
                         np.full(2 * n + 1, w, np.int64), role))
            rows += 2 * n + 1
            if rows >= ROWS:
                yield flushed()
                held, rows = [], 0
    if held:
        yield flushed()


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``w, n_near, best`` for the words ``w, word`` that have near words; ``best`` is the smallest number
    of a near word."""
    entries = vocabulary.select("w", "word").mapInArrow(
        _entries, "p1 long, p2 long, s1 long, s2 long, w long, role tinyint")
    groups = (entries.groupBy(*PAIR).agg(F.collect_list(F.struct("w", "role")).alias("g"))
              .where(F.size("g") > 1)
              .select(F.array_sort(F.expr("transform(filter(g, x -> x.role > 0), x -> x.w)")).alias("skips"),
                      F.array_sort(F.expr("transform(filter(g, x -> x.role = 1), x -> x.w)")).alias("firsts"),
                      F.expr("get(filter(g, x -> x.role = 0), 0).w").alias("whole")))
    # least() passes over nulls; a word alone under its pair has neither other words nor a shorter one
    found = groups.select(F.explode(F.expr("""concat(
        transform(skips, u -> named_struct('w', u,
            'k', size(skips) - 1 + if(whole is not null and array_contains(firsts, u), 1, 0),
            'best', least(if(u = get(skips, 0), get(skips, 1), get(skips, 0)),
                          if(array_contains(firsts, u), whole, null)))),
        if(whole is null, array(), array(named_struct('w', whole, 'k', size(firsts),
            'best', get(firsts, 0)))))""")).alias("x")).select("x.*")
    return (found.where("k > 0").groupBy("w")
            .agg(F.sum("k").cast("long").alias("n_near"), F.min("best").alias("best")))


def _roots(forms: DataFrame, hops: int) -> DataFrame:
    """``w, root`` from the links ``w, form`` of chains of at most ``hops`` links, by pointer doubling."""
    at = forms.select("w", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(hops, 1)))):
        # many words may point at one root: its next link is looked up under salts
        onward = at.select(F.col("w").alias("root"), F.col("root").alias("next"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        at = store(at.withColumn("salt", F.pmod("w", F.lit(SALTS)).cast("int"))
                   .join(onward.hint("merge"), ["root", "salt"], "left")
                   .select("w", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return at


def variants(docs: DataFrame, *, min_length: int = 6, min_count: int = 5, ratio: int = 5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``; ``form`` is null for a word that is no
    variant, ``root`` is where its forms end (the word itself without a form)."""
    counted = store(words(docs, min_length=min_length, min_count=min_count, id_col=id_col,
                          text_col=text_col), "spelling-words")
    vocabulary = store(numbered(counted.withColumn("order", -F.col("n")), ["order", "word"], "w")
                       .drop("order"), "spelling-numbered")
    near = store(neighbours(vocabulary), "spelling-near")
    target = vocabulary.select(F.col("w").alias("best"), F.col("word").alias("form"),
                               F.col("n").alias("form_n"))
    linked = (vocabulary.join(near.hint("merge"), "w", "left").join(target.hint("merge"), "best", "left")
              .withColumn("ok", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))))
    linked = store(linked.select(
        "w", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("best", "form", "form_n")]), "spelling-linked")
    most = vocabulary.agg(F.max("n")).first()[0] or 0
    hops = max(1, math.ceil(math.log(max(most / min_count, 1), ratio)) + 1)
    roots = _roots(linked.where("best is not null").select("w", F.col("best").alias("form")), hops)
    ends = vocabulary.select(F.col("w").alias("root"), F.col("word").alias("root_word"))
    named = roots.join(ends.hint("merge"), "root").select("w", "root_word")
    return linked.join(named.hint("merge"), "w", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
