"""Phrase collocations from FM-indexes over word ids.

Texts are cut into shards of a bounded number of words. A shard stores its sequence of words as local
ids. Words that are frequent in their whole language get global ids from a join, all other words
become gaps, since no frequent phrase holds one. Each shard then gets a bidirectional FM-index: the
Burrows-Wheeler transforms of its sequence and of the reversed sequence, both sorted to the length
that is asked for. Phrases are listed by extending intervals, words to the right in one transform
and longer phrases to the left in the other, with the matching interval of the other direction kept
up to date. Counts are summed across shards, which also sums what extends a phrase on each side.

Lengths are listed one after the other, since a frequent phrase holds frequent shorter ones only. Those of
the length before are sent out as a bitmap of fixed size that may let a few others through; exact sums
decide. Shards, dictionary and phrases are tables: none is broadcast or brought to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm import textbytes as tb
from demandloom.llm.scratch import Scratch

#: Words of a shard; a longer text is a shard of its own.
SHARD_WORDS = 1 << 18
#: Bits of the map of frequent phrases that is sent to all tasks: 8 MB for any corpus.
MAP_BITS = 1 << 26
#: Candidates of one language that are ranked in one task, before the best of each are ranked together.
RANK_PARTS = 64

#: Ends of pieces: ``.,;:!?`` and the controls 10 to 13.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
#: What parts words: the ends of pieces, space and tab.
_GAPS = _ENDS.copy()
_GAPS[[32, 9]] = True

SHARDS = "shard long, langs array<string>, words array<binary>, lang_of array<int>, counts array<long>, sequence binary"


class Sequence(NamedTuple):
    """Words of some texts: codes into ``words``, -1 at the end of each piece, and each text's word count."""

    codes: np.ndarray
    words: pa.Array
    doc: np.ndarray


def read_pieces(texts: list[bytes]) -> Sequence:
    """Lower-cased words of the texts in order, with ``-1`` between pieces and between texts."""
    found = tb.find_words(texts, _GAPS)
    if not len(found.starts):
        return Sequence(np.zeros(0, np.int32), pa.array([], pa.binary()), np.zeros(0, np.int64))
    data = tb.LOWER[found.data]
    inside = ~_GAPS[found.data]
    lengths = (found.ends - found.starts).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    packed = pa.Array.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    ).dictionary_encode()
    codes = packed.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    ends = np.concatenate(([0], np.cumsum(_ENDS[found.data], dtype=np.int64)))
    # a new piece starts at a word with an end of piece, or of a text, before it
    fresh = np.ones(len(codes), dtype=bool)
    fresh[1:] = (ends[found.starts[1:]] > ends[found.ends[:-1]]) | (found.doc[1:] != found.doc[:-1])
    place = np.arange(len(codes)) + np.cumsum(fresh)
    out = np.full(place[-1] + 2, -1, dtype=np.int32)
    out[place] = codes
    owner = np.zeros(len(out), dtype=np.int64)
    owner[place] = found.doc
    return Sequence(out, packed.dictionary.cast(pa.binary()), owner)


def _shard_row(number: int, texts: list[bytes], langs: list[str]) -> pa.RecordBatch:
    """One shard: its languages, the words of each with their counts, and the sequence of local ids from 1."""
    kinds = sorted(set(langs))
    place = {lang: i for i, lang in enumerate(kinds)}
    lang_of = np.array([place[x] for x in langs], dtype=np.int64)
    read = read_pieces(texts)
    word = read.codes >= 0
    # the same word of two languages is two symbols
    symbol, local, counts = np.unique(
        read.codes[word].astype(np.int64) * len(kinds) + lang_of[read.doc[word]], return_inverse=True, return_counts=True
    )
    sequence = np.zeros(len(read.codes), dtype="<i4")
    sequence[word] = local + 1
    words = read.words.take(pa.array(symbol // len(kinds)))
    columns = [
        pa.array([number], pa.int64()),
        pa.array([kinds], pa.list_(pa.string())),
        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
        pa.array([(symbol % len(kinds)).astype(np.int32)], pa.list_(pa.int32())),
        pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
        pa.array([sequence.tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["shard", "langs", "words", "lang_of", "counts", "sequence"])


def cut_shards(docs: DataFrame, words: int = SHARD_WORDS) -> DataFrame:
    """Rows of ``SHARDS``; the only pass over the texts.

    Shards are numbered by task, so the table has to be written before it is read more than once.
    """
    most_bytes = 8 * words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        texts: list[bytes] = []
        langs: list[str] = []
        held = 0
        for rows, part in tb.slices(batches):
            for text, lang in zip(part, rows.column("lang").to_pylist()):
                if held and held + len(text) > most_bytes:
                    yield _shard_row(number, texts, langs)
                    number, texts, langs, held = number + 1, [], [], 0
                texts.append(text)
                langs.append(lang)
                held += len(text) + 1
        if texts:
            yield _shard_row(number, texts, langs)

    known = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return known.filter(F.length("text") > 0).mapInArrow(run, SHARDS)


def shard_words(shards: DataFrame) -> DataFrame:
    """``shard, local, lang, word, n``: the words of each shard, with their ids in its sequence."""
    one = F.posexplode(F.arrays_zip("words", "lang_of", "counts")).alias("place", "w")
    return shards.select("shard", "langs", one).select(
        "shard",
        (F.col("place") + 1).alias("local"),
        F.col("langs")[F.col("w.lang_of")].alias("lang"),
        F.col("w.words").cast("string").alias("word"),
        F.col("w.counts").alias("n"),
    )


class FmIndex:
    """Both transforms of a sequence of symbols, sorted to ``depth`` symbols; symbol 0 is a gap.

    ``keys`` lists (symbol, place) of a transform in order, so the place of ``symbol * size + i``
    is where the interval of the symbol, extended by the first ``i`` rows, starts.
    """

    def __init__(self, sequence: np.ndarray, symbols: int, depth: int) -> None:
        # what comes before the first symbol, in either direction, is a gap
        self.sequence = np.concatenate(([0], sequence, [0])).astype(np.int64)
        self.size, self.symbols, self.depth = len(self.sequence), symbols, depth

    @cached_property
    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each context, and the keys of that transform."""
        return self._transform(self.sequence)

    @cached_property
    def after(self) -> tuple[np.ndarray, np.ndarray]:
        """The same of the reversed sequence: the symbol behind each context."""
        return self._transform(self.sequence[::-1])

    def _transform(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(sequence)
        padded = np.concatenate((sequence, np.zeros(self.depth, np.int64)))
        order = np.arange(n)
        bits = max(int(self.symbols).bit_length(), 1)
        each = 62 // bits
        # symbols of the context are packed into as few sort keys as they fit
        for stop in range(self.depth, 0, -each):
            key = np.zeros(n, dtype=np.int64)
            for i in range(max(stop - each, 0), stop):
                key = (key << bits) | padded[i : i + n]
            order = order[np.argsort(key[order], kind="stable")]
        transform = sequence[order - 1]
        return transform, np.sort(transform * n + np.arange(n))

    def words(self) -> "Intervals":
        """The interval of every symbol but the gap: the same rows in either transform."""
        count = np.bincount(self.sequence, minlength=self.symbols + 1)
        low = np.cumsum(count) - count
        symbol = np.flatnonzero(count[1:]) + 1
        return Intervals(symbol[:, None], low[symbol], low[symbol], count[symbol])

    def extend(self, at: "Intervals", left: bool) -> "Intervals":
        """All one-symbol extensions of the phrases, on the left or on the right."""
        transform, keys = self.before if left else self.after
        own, other = (at.low, at.low_reverse) if left else (at.low_reverse, at.low)
        phrase = np.repeat(np.arange(len(own)), at.count)
        within = np.arange(len(phrase)) - np.repeat(np.cumsum(at.count) - at.count, at.count)
        pair = phrase * (self.symbols + 1) + transform[own[phrase] + within]
        pair, count = np.unique(pair, return_counts=True)
        phrase, symbol = pair // (self.symbols + 1), pair % (self.symbols + 1)
        # in the other direction the extension follows the smaller symbols of the same phrase
        smaller = np.cumsum(count) - count
        first = np.searchsorted(phrase, np.arange(len(own)))
        smaller = smaller - smaller[np.minimum(first, len(smaller) - 1)][phrase] if len(phrase) else smaller
        known = symbol > 0
        phrase, symbol, count, smaller = phrase[known], symbol[known], count[known], smaller[known]
        low = np.searchsorted(keys, symbol * self.size + own[phrase])
        other_low = other[phrase] + smaller
        old = at.phrases[phrase]
        if left:
            return Intervals(np.column_stack((symbol, old)), low, other_low, count)
        return Intervals(np.column_stack((old, symbol)), other_low, low, count)


class Intervals(NamedTuple):
    """Phrases of one length, one row of symbols each, with their rows in both transforms."""

    phrases: np.ndarray
    low: np.ndarray
    low_reverse: np.ndarray
    count: np.ndarray


class PhraseMap(NamedTuple):
    """A bitmap of phrases of one length: it never misses one, and may take others for one."""

    bits: np.ndarray

    @staticmethod
    def places(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Two bits of each phrase, given the words of all phrases by place."""
        code = np.zeros(len(ids[0]), dtype=np.uint64)
        for column in ids:
            code = tb.mix(code * np.uint64(31) + column.astype(np.uint64) + np.uint64(1))
        return code % np.uint64(MAP_BITS), (code >> np.uint64(32)) % np.uint64(MAP_BITS)

    def holds(self, ids: list[np.ndarray]) -> np.ndarray:
        found = np.ones(len(ids[0]), dtype=bool)
        for at in self.places(ids):
            found &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return found


def phrase_map(phrases: DataFrame, length: int) -> PhraseMap:
    """The map of all rows; tasks set bits, and at most ``MAP_BITS / 64`` words of bits reach the driver."""
    names = _ids(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(PhraseMap.places([batch.column(c).to_numpy() for c in names]))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bits"])

    found = phrases.select(*names).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS >> 6, dtype=np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return PhraseMap(bits)


def list_phrases(sequence: np.ndarray, ids: np.ndarray, length: int, maps: dict[int, PhraseMap]) -> Intervals:
    """Phrases of ``length`` words of a sequence with their counts, whose parts are in ``maps``, by length.

    Symbol k stands for word ``ids[k - 1]``. Words are extended to the right, longer phrases to the left.
    """
    index = FmIndex(sequence, len(ids), length)
    at = index.words()
    for size in range(2, length + 1):
        at = index.extend(at, left=size > 2)
        known = np.ones(len(at.count), dtype=bool)
        columns = [ids[at.phrases[:, k] - 1] for k in range(size)]
        if size in maps:
            known = maps[size].holds(columns)
        elif size - 1 in maps:  # the part on the right has been looked up already
            known = maps[size - 1].holds(columns[:-1])
        at = Intervals(*[x[known] for x in at])
    return at


def _ids(longest: int) -> list[str]:
    return [f"w{i}" for i in range(longest)]


INDEXED = "sequence binary, ids binary"


def known_words(shards: DataFrame) -> DataFrame:
    """``INDEXED``: sequences of symbols from 1 for the words in ``ids``, pairs of local and global id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sequence = np.frombuffer(batch.column("sequence")[i].as_buffer(), dtype="<i4")
                pairs = batch.column("ids")[i].values
                local = pairs.field("local").to_numpy(zero_copy_only=False)
                ids = pairs.field("id").to_numpy(zero_copy_only=False).astype("<i8")
                dense = np.zeros(max(int(sequence.max(initial=0)), int(local.max(initial=0))) + 1, dtype="<i4")
                dense[local] = np.arange(1, len(local) + 1)
                compact = dense[sequence]
                # one gap says as much as many
                compact = compact[~((compact == 0) & np.concatenate(([True], compact[:-1] == 0)))]
                columns = [pa.array([x.tobytes()], pa.binary()) for x in (compact, ids)]
                yield pa.RecordBatch.from_arrays(columns, ["sequence", "ids"])

    return shards.select("sequence", "ids").mapInArrow(run, INDEXED)


def shard_phrases(indexed: DataFrame, length: int, maps: dict[int, PhraseMap]) -> DataFrame:
    """``w0 … , n``: phrases of ``length`` words of each shard, by global word ids."""
    names = _ids(length)
    shipped = indexed.sparkSession.sparkContext.broadcast(maps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sequence = np.frombuffer(batch.column("sequence")[i].as_buffer(), dtype="<i4")
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), dtype="<i8")
                found = list_phrases(sequence, ids, length, shipped.value)
                for a in range(0, len(found.count), 65_536):
                    part = found.phrases[a : a + 65_536]
                    columns = [pa.array(ids[part[:, k] - 1]) for k in range(length)]
                    columns.append(pa.array(found.count[a : a + 65_536].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(columns, [*names, "n"])

    return indexed.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))


def count_phrases(docs: DataFrame, scratch: Scratch, longest: int, least: int) -> tuple[DataFrame, DataFrame, dict[int, DataFrame]]:
    """``(lang, n)``, frequent words ``(id, lang, word, n)`` and, by length, frequent phrases ``(w0 …, n)``."""
    shards = scratch.keep("shards", cut_shards(docs))
    words = shard_words(shards)
    totals = scratch.keep("words", words.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    sizes = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = scratch.keep("frequent", totals.filter(F.col("n") >= least).withColumn("id", F.monotonically_increasing_id()))
    ids = (
        words.select("shard", "local", "lang", "word")
        .join(frequent.select("lang", "word", "id"), ["lang", "word"])
        .groupBy("shard")
        .agg(F.collect_list(F.struct("local", "id")).alias("ids"))
    )
    indexed = scratch.keep("indexed", known_words(shards.select("shard", "sequence").join(ids, "shard")))
    scratch.drop("shards")
    phrases: dict[int, DataFrame] = {}
    maps: dict[int, PhraseMap] = {}
    for length in range(2, longest + 1):
        listed = shard_phrases(indexed, length, maps).groupBy(*_ids(length)).agg(F.sum("n").alias("n"))
        phrases[length] = scratch.keep(f"phrases-{length}", listed.filter(F.col("n") >= least))
        if length < longest:
            maps[length] = phrase_map(phrases[length], length)
    return sizes, frequent, phrases


def lowest_cut(scale: int = 1_000_000) -> Column:
    """The lowest-scoring cut ``(score, k, l, r)`` of a row: floor(scale * a * a / (l * r)), ties to the smallest k.

    ``firsts`` and ``rests`` hold, for each k from 1, the counts of the first k words and of the others.
    Decimals of 38 digits are exact for counts below 10 ** 16.
    """
    exact = lambda x: x.cast("decimal(19,0)")
    top = exact(F.col("a")) * exact(F.col("a")) * F.lit(scale)
    cuts = F.zip_with("firsts", "rests", lambda l, r: F.struct(l.alias("l"), r.alias("r")))
    return F.array_min(
        F.transform(
            cuts,
            lambda x, i: F.struct(
                F.call_function("div", top, exact(x["l"]) * exact(x["r"])).cast("long").alias("score"),
                (i + 1).alias("k"),
                x["l"].alias("l"),
                x["r"].alias("r"),
            ),
        )
    )


def with_parts(frequent: DataFrame, phrases: dict[int, DataFrame], scratch: Scratch, longest: int) -> list[DataFrame]:
    """For each length from 1, the phrases with ``lang, words, a, firsts, rests``.

    A phrase gets the counts of its parts from the two phrases that lack its last and its first
    word, so each length needs two joins, by all words but one.
    """
    ids = _ids(longest)
    none = F.array().cast("array<long>")
    levels = [
        frequent.select(F.col("id").alias(ids[0]), "lang", F.array("word").alias("words"), F.col("n").alias("a"), none.alias("firsts"), none.alias("rests"))
    ]
    for length in range(2, longest + 1):
        shorter = levels[-1]
        front = shorter.select(*ids[: length - 1], "lang", F.col("words").alias("head"), F.col("a").alias("front"), "firsts")
        back = shorter.select(
            *[F.col(a).alias(b) for a, b in zip(ids, ids[1:length])], F.element_at("words", -1).alias("last"), F.col("a").alias("back"), "rests"
        )
        level = (
            phrases[length].join(front, ids[: length - 1])
            .join(back, ids[1:length])
            .select(
                *ids[:length],
                "lang",
                F.concat("head", F.array("last")).alias("words"),
                F.col("n").alias("a"),
                F.concat("firsts", F.array("front")).alias("firsts"),
                F.concat(F.array("back"), "rests").alias("rests"),
            )
        )
        levels.append(scratch.keep(f"length-{length}", level))
    return levels


def not_inside(level: DataFrame, longer: DataFrame, ids: list[str], percent: int) -> DataFrame:
    """Phrases without an extension by a word on either side that has ``percent`` of their count.

    Phrases that are longer still occur no more often than those in between, so one word is enough.
    """
    size = len(ids)
    width = [c for c in longer.columns if c.startswith("w") and c[1:].isdigit()]
    sides = [longer.select(*[F.col(c).alias(d) for c, d in zip(part, ids)], F.col("a").alias("most")) for part in (width[:size], width[1:])]
    most = sides[0].unionByName(sides[1]).groupBy(*ids).agg(F.max("most").alias("most"))
    return level.join(most, ids, "left").filter(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a")))


def mine_phrases(docs: DataFrame, longest: int = 3, least: int = 10, inside_percent: int = 50, best: int = 2000) -> DataFrame:
    """The ``best`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Phrases of 2 to ``longest`` words with ``a >= least`` occurrences are scored by their weakest cut;
    those inside a longer one that has ``inside_percent`` of their occurrences are left out. A NULL lang is
    ``und``, a NULL text is empty, repeated rows count each time, ties go by count and then by the phrase's
    bytes. A long text is a shard of its own, so a task needs about a hundred bytes for each of its
    words. Ids and extra columns are not read. A table without frequent phrases gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    ids = _ids(longest)
    sizes, frequent, phrases = count_phrases(docs, scratch, longest, least)
    levels = with_parts(frequent, phrases, scratch, longest)
    scored = None
    for length in range(2, longest + 1):
        kept = levels[length - 1]
        if length < longest:
            kept = not_inside(kept, levels[length], ids[:length], inside_percent)
        rows = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", lowest_cut().alias("cut"))
        scored = rows if scored is None else scored.unionByName(rows)
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = Window.partitionBy("lang", "part").orderBy(*order)
    ranked = scored.withColumn("part", part).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= best)
    whole = Window.partitionBy("lang").orderBy(*order)
    return (
        ranked.withColumn("rank", F.row_number().over(whole).cast("long"))
        .filter(F.col("rank") <= best)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    )
