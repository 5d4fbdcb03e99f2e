"""Collocations from a prefix-free parsing of the corpus.

Where a window of words has a certain hash a new chunk of the text begins, so
that equal passages are cut alike; a chunk runs on over the window that begins
the next one.  Distinct chunks form a dictionary with their frequencies, and
phrases are counted inside it, weighted; of a phrase in an overlap only the
chunk in which it starts before the overlap counts it.  Phrases grow by a word
a round, and only where both shorter phrases in them may be frequent.  Words
and pairs, of which most are rare, are first added up in a bounded number of
buckets; phrases of a bucket that stays small are rare and never leave their task.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import shuffle_partitions, written
from martline.session import checked_broadcast

#: Words between the starts of chunks, on average and at most.
CHUNK_WORDS, LONGEST_CHUNK = 64, 4096
#: Bytes of a text that are cut into words at a time.
BLOCK_BYTES = 1 << 22
#: Bytes of a word whose hash is computed in one go with all others; longer ones are hashed one by one.
LONG_WORD = 4096
#: Buckets of phrases by hash, and bits of the filter of frequent ones that every task of a round
#: gets. Rare phrases in a bucket with others are counted and dropped afterwards, so this bounds memory, not results.
FILTER_BITS = 1 << 26
#: Entries that a task adds up before it passes them on.
HELD_ENTRIES = 1 << 21

_BUCKET_BITS = 1 << 15  # bits of one bitmap of Spark's
_MARK = b"\xff"  # a border between pieces of a text; no byte of UTF-8
_BORDERS = b".,;:!?\n\x0b\x0c\r"
_CUT = bytes.maketrans(_BORDERS + b"\t", _MARK * len(_BORDERS) + b" ")
_FACTOR, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)

ROWS = "lang string, chunk binary, own int, times long"
COUNTS = "lang string, phrase binary, bucket long, times long"


class _Words:
    """Words with one blank between them, as places in their bytes, and their hashes."""

    def __init__(self, data: bytes) -> None:
        self.data, self.bytes = data, np.frombuffer(data, dtype=np.uint8)
        blanks = np.flatnonzero(self.bytes == 32)
        self.starts, self.ends = np.append(0, blanks + 1), np.append(blanks, len(data))
        if not data:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int) -> np.ndarray:
        """A 64-bit hash of every word, one of two that have nothing to do with each other."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        sizes = self.ends - self.starts
        # Place of each byte in its word; the blank behind a word belongs to it and counts nothing.
        place = np.arange(len(self.bytes)) - np.repeat(self.starts, np.append(sizes[:-1] + 1, sizes[-1]))
        value = (self.bytes.astype(np.uint64) + np.uint64(1)) * _POWERS[which][np.minimum(place, LONG_WORD)]
        value[self.ends[:-1]] = 0
        found = np.add.reduceat(value, self.starts) + sizes.astype(np.uint64)
        for n in np.flatnonzero(sizes > LONG_WORD).tolist():
            found[n] = xxhash.xxh64_intdigest(self.data[self.starts[n]:self.ends[n]], seed=which)
        found = (found ^ (found >> np.uint64(32))) * _FACTOR
        return found ^ (found >> _TURN)

    def text(self, first: int, words: int) -> bytes:
        return self.data[self.starts[first]:self.ends[first + words - 1]]


def _powers(factor: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(LONG_WORD, factor, dtype=np.uint64)))


_POWERS = _powers(0xD6E8FEB86659FD93), _powers(0xA0761D6478BD642F)


def _blocks(data: bytes) -> Iterator[bytes]:
    """A text cut at blanks or borders into parts of bounded length (or one word)."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        if end < len(data):
            ends = [p for p in (data.find(b" ", end), data.find(_MARK, end)) if p >= 0]
            end = min(ends, default=len(data))
        yield data[at:end]
        at = end


def chunks_of(text: str, overlap: int) -> Iterator[tuple[bytes, int]]:
    """Chunks of a text, and how many of their words (or borders) belong to no later chunk."""
    data = text.encode("utf-8").lower().translate(_CUT)  # of bytes, only A-Z have a lower case
    blocks = [data] if len(data) <= BLOCK_BYTES else _blocks(data)
    rest: list[bytes] = []
    for block in blocks:
        words = [*rest, *block.replace(_MARK, b" \xff ").split()]
        if block is data:  # a text of one block
            rest = words
            break
        open_words = _Words(b" ".join(words))
        done = yield from _cut(open_words, overlap, last=False)
        rest = words[done:]
    yield from _cut(_Words(b" ".join(rest + [_MARK] * overlap)), overlap, last=True)


def _cut(words: _Words, overlap: int, last: bool) -> Iterator[tuple[bytes, int]]:
    """Chunks of the words; the last one stays open for more words unless it is the text's last. Returns where that begins."""
    count = len(words) - overlap
    if count <= 0:
        return 0
    window = _window_hash(words.hashes(0), np.uint64(0), overlap)[:count]
    starts = np.flatnonzero(window % np.uint64(CHUNK_WORDS) == 0)
    starts = np.append(0, starts[starts > 0])
    gaps = np.diff(starts, append=count)
    if gaps.max() > LONGEST_CHUNK:
        starts = np.concatenate([np.arange(s, s + g, LONGEST_CHUNK) for s, g in zip(starts.tolist(), gaps.tolist())])
    for a, b in itertools.pairwise(starts.tolist()):
        yield words.text(a, b - a + overlap), b - a
    if last:
        yield words.text(int(starts[-1]), count + overlap - int(starts[-1])), count - int(starts[-1])
    return int(starts[-1])


def _window_hash(hashes: np.ndarray, seed: np.ndarray | np.uint64, words: int) -> np.ndarray:
    """Hash of each run of so many words, by its first word; runs past the end are left out."""
    count = max(0, len(hashes) - words + 1)
    found = np.broadcast_to(seed, hashes.shape)[:count]
    for n in range(words):
        found = (found ^ hashes[n:n + count]) * _FACTOR
        found = found ^ (found >> _TURN)
    return found


class _Batch(_Words):
    """The words of a batch of chunks in flat arrays."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        lang, chunk, own, times = (batch.column(n) for n in ("lang", "chunk", "own", "times"))
        chunks = chunk.to_pylist()
        super().__init__(b" ".join(chunks))
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        first = np.searchsorted(self.starts, np.cumsum(lengths + 1) - lengths - 1)  # each row's first word
        sizes = np.diff(first, append=len(self))
        self.first = self.hashes(0)
        self.is_word = (self.ends - self.starts != 1) | (self.bytes[self.starts] != _MARK[0])
        coded = lang.dictionary_encode()
        self.langs: list[str] = coded.dictionary.to_pylist()
        seeds = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], dtype=np.uint64)
        self.row = np.repeat(np.arange(len(chunks)), sizes)
        self.lang = coded.indices.to_numpy()[self.row]
        self.seed = seeds[self.lang] if len(self.langs) else np.zeros(0, dtype=np.uint64)
        place = np.arange(len(self))
        self.left = np.repeat(first + own.to_numpy(), sizes) - place  # own starts from here on
        self.end = np.repeat(first + sizes, sizes) - place  # words of the row from here on
        self.times = times.to_numpy()[self.row]

    def whole(self, words: int) -> np.ndarray:
        """Where runs of so many words start that hold no border and stay in their row."""
        found = self.end >= words
        for n in range(words):
            found[:len(found) - n] &= self.is_word[n:]
        return found

    def buckets(self, words: int, bits: int) -> np.ndarray:
        """Bucket of the run of so many words at each place but the last ones."""
        return _window_hash(self.first, self.seed, words) & np.uint64(bits - 1)

    def frequent(self, bits: np.ndarray, words: int) -> np.ndarray:
        """Where a run of so many words starts that may be frequent, by the filter."""
        found, bucket = self.whole(words), self.buckets(words, len(bits) * 8)
        found[len(bucket):] = False
        found[:len(bucket)] &= (bits[(bucket >> np.uint64(3)).astype(np.int64)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def places(self, words: int, known: np.ndarray | None) -> np.ndarray:
        """Where phrases of so many words start that this row counts, if the shorter ones in them may be frequent."""
        counted = self.whole(words) & (self.left > 0)
        if known is not None:
            shorter = self.frequent(known, words - 1)
            counted[:-1] &= shorter[:-1] & shorter[1:]
            counted[-1:] = False
        return np.flatnonzero(counted)

    def counts(self, at: np.ndarray, words: int) -> tuple[list[str], list[bytes], np.ndarray]:
        """Language, phrase and frequency of the distinct phrases that start at these places, told apart by 128 bits."""
        if not len(at):
            return [], [], np.zeros(0, dtype=np.int64)
        one, two = _window_hash(self.first, self.seed, words)[at], _window_hash(self.hashes(1), ~self.seed, words)[at]
        order = np.argsort(one)
        new = one[order][1:] != one[order][:-1]
        if (~new & (two[order][1:] != two[order][:-1])).any():  # two phrases share the first 64 bits
            order = np.lexsort((two, one))
            new = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        at, begin = at[order], np.append(0, np.flatnonzero(new) + 1)
        first = at[begin].tolist()
        return [self.langs[n] for n in self.lang[first].tolist()], [self.text(a, words) for a in first], np.add.reduceat(self.times[at], begin)


class _Sums:
    """Frequencies by bucket, added up before they are passed on."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, buckets: np.ndarray, times: np.ndarray) -> None:
        self.held.append((buckets, times))
        self.size += len(buckets)
        if self.size > HELD_ENTRIES:
            self.held = [self.total()]
            self.size = len(self.held[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        buckets, times = (np.concatenate([x[n] for x in self.held]) for n in (0, 1))
        room = np.int64(63 - self.bits.bit_length())
        if len(times) and int(times.max()) >> int(room) == 0:  # both in one number, which sorts faster
            packed = np.sort((buckets << room) | times)
            buckets, times = packed >> room, packed & ((np.int64(1) << room) - 1)
        else:
            order = np.argsort(buckets)
            buckets, times = buckets[order], times[order]
        begin = np.append(0, np.flatnonzero(np.diff(buckets)) + 1) if len(buckets) else np.zeros(0, dtype=np.int64)
        return buckets[begin], np.add.reduceat(times, begin) if len(begin) else times

    def take(self) -> Iterator[pa.RecordBatch]:
        found, times = self.total()
        self.held, self.size = [], 0
        if len(found):
            yield _rows([None] * len(found), [None] * len(found), found, times)


def _rows(langs: list, phrases: list, buckets: np.ndarray | None, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()),
         pa.nulls(len(langs), pa.int64()) if buckets is None else pa.array(buckets.astype(np.int64)), pa.array(times)],
        names=["lang", "phrase", "bucket", "times"])


_Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _counter(words: int, known: np.ndarray | None = None, bits: int = 0, exact: int = 0) -> _Pass:
    """Counts phrases of so many words: by bucket if there are ``bits`` of them, else by the phrase.

    ``exact`` words at a time, phrases that may be frequent by ``known`` are
    counted by themselves as well, and all words as the empty phrase.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(bits)
        for batch in map(_Batch, batches):
            if exact:
                langs, phrases, times = batch.counts(np.flatnonzero(batch.frequent(known, exact) & (batch.left > 0)), exact)
                yield _rows(langs, phrases, None, times)
                total, at = np.zeros(len(batch.langs), dtype=np.int64), batch.places(1, None)
                np.add.at(total, batch.lang[at], batch.times[at])
                yield _rows(batch.langs, [b""] * len(batch.langs), None, total)
            at = batch.places(words, known)
            if bits:
                sums.add(batch.buckets(words, bits)[at].astype(np.int64), batch.times[at])
                if sums.size > HELD_ENTRIES:
                    yield from sums.take()
            elif len(at):
                langs, phrases, times = batch.counts(at, words)
                yield _rows(langs, phrases, None, times)
        yield from sums.take()
    return run


def _cutter(words: int, bits: np.ndarray, least: int) -> _Pass:
    """Cuts chunks to the runs in which every phrase of so many words may be frequent, if so many of them follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(_Batch, batches):
            at = np.flatnonzero(batch.frequent(bits, words))
            if not len(at):
                continue
            breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(batch.row[at]) != 0)) + 1
            first, last = at[np.append(0, breaks)], at[np.append(breaks, len(at)) - 1]
            own = np.minimum(last + 1 - first, batch.left[first])
            keep = (last - first >= least - 1) & (own > 0)
            first, last, own = first[keep], last[keep], own[keep]
            chunks = [batch.text(a, b + words - a) for a, b in zip(first.tolist(), last.tolist())]
            langs = [batch.langs[x] for x in batch.lang[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(chunks, pa.binary()), pa.array(own.astype(np.int32)),
                                              pa.array(batch.times[first])], names=["lang", "chunk", "own", "times"])
    return run


def _distinct(chunks: DataFrame, name: str) -> DataFrame:
    return written(chunks.groupBy("lang", "chunk", "own").agg(F.sum("times").alias("times")), name, "zstd")


def phrase_dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", overlap: int = 4) -> DataFrame:
    """``lang, chunk, own, times``: the distinct chunks of all texts and how often each occurs.

    The first ``own`` words (or borders) of a chunk are its own, the
    ``overlap`` others belong to the next one or lie behind the text's end.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, found = [], []
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    before = len(found)
                    found += chunks_of(text, overlap)
                    langs += [lang] * (len(found) - before)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()), pa.array([c for c, _ in found], pa.binary()),
                     pa.array([n for _, n in found], pa.int32()), pa.array(np.ones(len(found), dtype=np.int64))], names=["lang", "chunk", "own", "times"])

    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return _distinct(texts.mapInArrow(run, ROWS), "phrase-dictionary")


def _filter_bits(buckets: DataFrame, bits: int) -> np.ndarray:
    """One bit for every ``bucket`` in the rows: ``bits / 8`` bytes at most, whatever their number."""
    rows = buckets.groupBy(F.expr(f"bucket div {_BUCKET_BITS}").alias("at")).agg(
        F.bitmap_construct_agg(F.col("bucket") % _BUCKET_BITS).alias("bitmap")).collect()
    found = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        found[row["at"] * (_BUCKET_BITS // 8):][:_BUCKET_BITS // 8] = np.frombuffer(bytes(row["bitmap"]), dtype=np.uint8)
    return found


def _bucket_of(bits: int) -> _Pass:
    """The bucket of each phrase, as the tasks of the next round compute it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, seed = _Words(phrase), np.uint64(xxhash.xxh64_intdigest(lang))
                found.append(int(_window_hash(words.hashes(0), seed, len(words))[0] & np.uint64(bits - 1)))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["bucket"])
    return run


def frequent_phrases(dictionary: DataFrame, most_words: int = 5, least: int = 100, bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, words, f``: all phrases of up to so many words that occur at least so often.

    The empty phrase (no words) has the number of all words.  ``dictionary``
    must overlap by ``most_words - 1``, at least 1.  ``bits`` is a power of two of 32,768 or more.
    """
    def summed(chunks: DataFrame, counter: _Pass, name: str) -> DataFrame:
        counts = chunks.mapInArrow(counter, COUNTS).groupBy("lang", "phrase", "bucket").agg(F.sum("times").alias("f"))
        return written(counts.filter(F.col("f") >= least), name)

    def phrases(counts: DataFrame, words: int) -> DataFrame:
        return counts.filter("phrase IS NOT NULL").select(
            "lang", F.col("phrase").cast("string").alias("phrase"), F.when(F.length("phrase") == 0, 0).otherwise(words).alias("words"), "f")

    # Words by bucket; words of large buckets by themselves, and pairs of them by bucket; then the runs of such pairs.
    known = _filter_bits(summed(dictionary, _counter(1, bits=bits), "phrase-buckets-1"), bits)
    counts = summed(dictionary, _counter(2, known, bits=bits, exact=1), "phrase-buckets-2")
    found = [phrases(counts, 1)]
    known = _filter_bits(counts.filter("bucket IS NOT NULL"), bits)
    chunks = dictionary
    for words in range(2, most_words + 1):
        # Of phrases of one word less, two in a row make one of this length; pairs themselves are still to be counted.
        length = max(2, words - 1)
        chunks = _distinct(chunks.mapInArrow(_cutter(length, known, 1 if words == 2 else 2), ROWS), f"phrase-runs-{words}")
        counts = summed(chunks, _counter(words), f"phrases-{words}")
        found.append(phrases(counts, words))
        if words < most_words:
            known = _filter_bits(counts.select("lang", "phrase").mapInArrow(_bucket_of(bits), "bucket long"), bits)
    return reduce(DataFrame.unionByName, found)


def _exact_score(a: str, n: str, left: str, right: str) -> Column:
    """``floor(1000 * a * n / (left * right))`` exact: products of up to 38 digits, larger ones raise."""
    wide = {x: f"CAST({x} AS DECIMAL(19, 0))" for x in (a, n, left, right)}
    return F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {wide[a]} * {wide[n]}) div ({wide[left]} * {wide[right]})")


def score_phrases(frequent: DataFrame, top: int = 2000, absorbed_percent: int = 100) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best collocations of each language.

    The lowest score over all cuts of a phrase in two counts (ties: the
    earliest cut).  Phrases that stand inside a longer one at least
    ``absorbed_percent`` of the time are dropped, whether or not that one is.
    It is enough to look at phrases longer by one word: a phrase inside a much
    longer one is inside those between them, which are as frequent as that or more.
    """
    f = checked_broadcast(frequent.filter("words > 0").select(F.col("lang").alias("_fl"), F.col("phrase").alias("_fp"), "f"))
    total = checked_broadcast(frequent.filter("words = 0").select("lang", F.col("f").alias("n")))
    candidates = frequent.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("_left")).select(
        "*", F.expr("substring(phrase, length(_left) + 2)").alias("_right"))

    def counted(df: DataFrame, part: str, name: str) -> DataFrame:
        joined = df.join(f, (F.col("lang") == F.col("_fl")) & (F.col(part) == F.col("_fp")))
        return joined.withColumn(name, F.col("f")).drop("_fl", "_fp", "f", part)

    scored = counted(counted(cuts, "_left", "l"), "_right", "r").join(total, "lang")
    best = scored.withColumn("score", _exact_score("a", "n", "l", "r")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("_best")).select("lang", "phrase", "_best.*")
    shorter = F.array(F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)"),
                      F.expr("substring_index(phrase, ' ', words - 1)"))
    inside = candidates.filter("words > 2").select("lang", "a", F.explode(shorter).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("_longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (F.lit(100) * F.col("_longer") < F.lit(absorbed_percent) * F.col("a")))
    # First by parts of a language, so that no task sorts all its phrases.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(frequent.sparkSession)))
    kept = kept.withColumn("_part", part)
    kept = kept.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return kept.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_words: int = 5, least: int = 100,
                 top: int = 2000, absorbed_percent: int = 100, bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best collocations of each language.

    Texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into
    words at blanks and tabs, A-Z in lower case.  A null text has no words, a
    null language is ``und``.  Repeated rows count each; ties in score and
    frequency go by the phrase's bytes; other columns are not read; an empty
    table gives an empty result.
    """
    dictionary = phrase_dictionary(docs, text_col, lang_col, most_words - 1)
    return score_phrases(written(frequent_phrases(dictionary, most_words, least, bits), "phrases"), top, absorbed_percent)
