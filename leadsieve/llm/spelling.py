"""Spelling variants: words at one edit from each other, found with an index of variable-length grams.

A gram dictionary is grown from pairs of letters: grams that many words hold are extended by one letter, rarer ones are
left as they are. A word is cut, at each place, into the longest gram of the dictionary there, unless an earlier gram
reaches as far. For each word, a bound says how many of its grams one edit can change at most; so two words at one edit
share at least the rest, at the same place from the start or shifted by the edit. A word is listed under its rarest
grams only, one more than an edit can change: near words then meet in a list. Lists hold words of one length and grams
of one place. Of the pairs that meet, those that share fewer grams than either word's bound asks for are left out, and
the letters of the others are compared.

Words that one edit can change in all grams have no such bound. Two of them meet in a second index with pairs of letters
alone, of which one edit changes two. Large lists are cut into blocks, and pairs of blocks are units of bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadsieve.llm.common import staged, whole
from leadsieve.llm.pieces import Kept, slices

#: Letters of a word at least, and its occurrences over all documents.
LETTERS = 5
LEAST = 3
#: One in so many occurrences lacks a letter.
SLIPS = 97
#: A form is at least so many times as frequent as the word.
TIMES = 2
#: Letters of a gram.
SHORT, LONG = 2, 4
#: Grams in fewer places than this aren't extended; and at most so many of one length are.
COMMON = 2000
EXTENDED = 2000
#: A block of a list holds so many words and letters at most; so many letters of pairs are compared at once.
BLOCK_WORDS = 4096
BLOCK_LETTERS = 1 << 20
CELLS = 1 << 22
#: Words that a task counts before it sends them on.
HELD = 400_000


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, least: int = LEAST,
                  slips: int = SLIPS) -> DataFrame:
    """word, n: maximal runs of letters with A-Z lowered, counted; where the hash of id and run says so, a letter is gone."""
    import pyarrow as pa
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % letters).findall
    narrow = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), whole(text).alias("text"))

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in slices(batches):
            for own, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{own}:".encode())
                # Bytes are lowered in ASCII only.
                for word, n in Counter(runs(t.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % slips:
                        counts[word] += n
                    elif len(word) > letters:
                        at = h % len(word)
                        counts[word[:at] + word[at + 1:]] += n
            if len(counts) > HELD:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    return (narrow.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least))


class Grams:
    """A gram dictionary: {gram: number of places it has in the words}. Grams of SHORT letters need no entry."""

    def __init__(self, places: dict[str, int]):
        self.places = places
        self.longest = max([SHORT, *map(len, places)])
        self.begun = {g[:k] for g in places for k in range(SHORT, len(g))}
        self.inner = {g[a:b] for g in places for a in range(1, len(g) - 1) for b in range(a + 2, len(g) + 1)}

    def cut(self, word: str) -> list[tuple[int, int]]:
        """(begin, end) of each gram of the word, by place; none lies within an earlier one."""
        out, reached = [], 0
        for p in range(len(word) - SHORT + 1):
            e = min(len(word), p + self.longest)
            while e > p + SHORT and word[p:e] not in self.places:
                e -= 1
            if e > reached:
                out.append((p, e))
                reached = e
        return out

    def changed(self, word: str, cuts: list[tuple[int, int]]) -> int:
        """How many of these grams one edit changes at most.

        Those around the edit; those before it from the first place on whose gram might grow into it; and those after it
        that a gram through the edit might cover.
        """
        most, lo, hi = 0, 0, 0
        for i in range(len(word) + 1):
            # No gram further away is met; both ends only move on.
            while lo < len(cuts) and cuts[lo][0] <= i - self.longest:
                lo += 1
            while hi < len(cuts) and cuts[hi][0] < i + self.longest:
                hi += 1
            around = cuts[lo:hi]
            grows = next((p for p in range(max(0, i - self.longest + 1), i - SHORT + 1) if word[p:i] in self.begun), i)
            before = sum(p >= grows for p, e in around if e <= i)
            inserted = before + sum(p < i or word[i:e] in self.inner for p, e in around if e > i)
            replaced = before + sum(p <= i or word[i + 1:e] in self.inner for p, e in around if e > i) if i < len(word) else 0
            most = max(most, inserted, replaced)
        return most

    def rare_first(self, word: str, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """In an order that is the same for all words."""
        return sorted(cuts, key=lambda c: (self.places.get(word[c[0]:c[1]], 0), word[c[0]:c[1]], c[0]))


def dictionary(words: DataFrame, common: int = COMMON, extended: int = EXTENDED) -> Grams:
    """Grams of the words, lengthened where they are common.

    Collected: all pairs of letters (90 letters exist), then the extensions of at most `extended` grams of each length,
    which bounds the dictionary whatever the number of words.
    """
    import pyarrow as pa
    places: dict[str, int] = {}
    grow: set[str] | None = None
    for size in range(SHORT, LONG + 1):
        def run(batches, size=size, grow=grow):
            seen: Counter = Counter()
            for batch in slices(batches, 4096):
                for w in batch.column(0).to_pylist():
                    seen.update(g for g in (w[p:p + size] for p in range(len(w) - size + 1)) if grow is None or g[:-1] in grow)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             names=["gram", "n"])

        found = {r["gram"]: r["n"] for r in words.select("word").mapInArrow(run, "gram string, n long")
                 .groupBy("gram").agg(F.sum("n").alias("n")).collect()}
        places |= found
        line = max(common, sum(found.values()) // extended)
        grow = {g for g, n in found.items() if n > line}
        if not grow:
            break
    return Grams(places)


def _listed(grams: Grams, marks: Kept, word: str) -> Iterator[tuple]:
    """(level, need, marks of its grams by place, listed grams, their places), for each level the word is listed at."""
    pairs = [(p, p + SHORT) for p in range(len(word) - SHORT + 1)]
    cuts = grams.cut(word)
    need = len(cuts) - grams.changed(word, cuts)
    levels = [(1, need, cuts, cuts if need < 1 else grams.rare_first(word, cuts)[:len(cuts) - need + 1])]
    if need < 1:
        levels.append((0, len(pairs) - SHORT, pairs, grams.rare_first(word, pairs)[:SHORT + 1]))
    for level, at_least, own, listed in levels:
        held = bytearray(len(word))
        for p, e in own:
            held[p] = marks[word[p:e]]
        yield level, at_least, bytes(held), [word[p:e] for p, e in listed], [p for p, _ in listed]


def _cut(words: DataFrame, grams: Grams) -> DataFrame:
    """Words with their grams, one row for each level: letters (Latin-1 bytes), n, level, need, marks, grams, places."""
    import pyarrow as pa
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(grams)  # see dictionary
    kinds = {"letters": pa.binary(), "n": pa.int64(), "level": pa.int32(), "need": pa.int32(), "marks": pa.binary(),
             "grams": pa.list_(pa.string()), "places": pa.list_(pa.int32())}

    def run(batches):
        marks = Kept(lambda g: xxhash.xxh32_intdigest(g) % 255 + 1)
        for batch in slices(batches, 1024):
            made = [(w.encode("latin-1"), n, *row) for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for row in _listed(sent.value, marks, w)]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds.values(), strict=True)],
                                                 names=list(kinds))

    # Few bytes, much work: as many tasks as a shuffle has.
    dealt = words.select("word", "n").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    return dealt.mapInArrow(run, "letters binary, n long, level int, need int, marks binary, grams array<string>, places array<int>")


def _postings(cut: DataFrame) -> DataFrame:
    """The words' postings: under their own length, and as visitors of the words one letter longer, where later grams are one
    place on."""
    length = F.octet_length("letters")
    listed = cut.withColumn("one", F.explode(F.arrays_zip("grams", "places")))
    lists = F.array(*[F.struct(F.lit(visits).alias("visits"), (length + visits).alias("length"),
                               (F.col("one.places") + on).alias("place")) for visits, on in ((0, 0), (1, 0), (1, 1))])
    return listed.withColumn("at", F.explode(lists)).select(
        F.xxhash64("level", "one.grams", "at.length", "at.place").alias("key"), "at.visits", "letters", "n", "need", "marks")


def _units(postings: DataFrame, block_words: int, block_letters: int) -> DataFrame:
    """Postings with the unit they belong to: key, left and right block, own block."""
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("letters")).alias("held"))
    large = staged(sizes.filter((F.col("members") > block_words) | (F.col("held") > block_letters)).select(
        "key", F.least("members", F.greatest(F.ceil(F.col("members") / block_words), F.ceil(F.col("held") / block_letters)))
        .cast("int").alias("blocks")), "large-lists")
    split = postings.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    split = split.withColumn("block", F.pmod(F.xxhash64("letters"), F.col("blocks")).cast("int"))
    return split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "visits", "block",
        "need", "n", "letters", "marks")


LOW, HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _filled(x: np.ndarray) -> np.ndarray:
    """The highest bit of each byte that isn't zero."""
    return ((x & LOW) + LOW | x) & HIGH


def _lanes(flat: np.ndarray, length: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as columns of eight bytes each, zero beyond their end, and the same moved on by one byte."""
    rows = np.repeat(np.arange(len(length)), length)
    table = np.zeros((len(length), wide), dtype=np.uint8)
    table[rows, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    moved = np.zeros_like(table)
    moved[:, :-1] = table[:, 1:]
    return tuple(np.ascontiguousarray(t.view("<u8").T) for t in (table, moved))


class _Lists:
    """Whole units of postings, in order of unit, then own words before visitors."""

    def __init__(self, table, begin: np.ndarray):
        values = {c: np.asarray(table[c]) for c in ("visits", "block", "need", "left", "right")}
        self.need, self.block = values["need"], values["block"]
        self.across = values["left"] != values["right"]
        letters, marks = (_bytes(table[c]) for c in ("letters", "marks"))
        self.length = letters[1]
        count = len(self.length)
        end = np.repeat(np.append(begin[1:], count), np.diff(np.append(begin, count)))
        self.partners = np.where(values["visits"] == 0, end - np.arange(count) - 1, 0)
        self.wide = _width(self.length)
        self.letters, self.letters_on = _lanes(*letters, self.wide)
        self.marks, self.marks_on = _lanes(*marks, self.wide)

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows whose words are one edit apart; a pair may come from several lists."""
        upto = np.concatenate([[0], np.cumsum(self.partners)])
        most, at = max(1, CELLS // self.wide), 0
        while at < len(self.partners):
            stop = max(at + 1, int(np.searchsorted(upto, upto[at] + most, side="right")) - 1)
            a = np.repeat(np.arange(at, stop), self.partners[at:stop])
            b = a + 1 + np.arange(len(a)) - (upto[a] - upto[at])
            need = np.maximum(self.need[a], self.need[b])
            fine = (need >= 1) & (~self.across[a] | (self.block[a] != self.block[b]))
            a, b, need = a[fine], b[fine], need[fine]
            visits = self.length[a] != self.length[b]
            for one, tally, check in ((~visits, self._tally, self._replaced), (visits, self._tally_moved, self._inserted)):
                x, y, asked = a[one], b[one], need[one]
                fine = asked == 1  # the gram by which the two met
                more = np.flatnonzero(~fine)
                fine[more] = tally(x[more], y[more]) >= asked[more]
                x, y = x[fine], y[fine]
                fine = check(x, y)
                yield x[fine], y[fine]
            at = stop

    def _tally(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Grams that begin at the same place in both words."""
        n = np.zeros(len(a), dtype=np.int64)
        for own in self.marks:
            n += np.bitwise_count(_filled(own[b]) & ~_filled(own[a] ^ own[b]))
        return n

    def _tally_moved(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Grams of the shorter word that begin in the longer one at the same place or one further on."""
        n = np.zeros(len(a), dtype=np.int64)
        for own, on in zip(self.marks, self.marks_on, strict=True):
            n += np.bitwise_count(_filled(own[b]) & ~(_filled(own[a] ^ own[b]) & _filled(on[a] ^ own[b])))
        return n

    def _replaced(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = np.zeros(len(a), dtype=np.int64)
        for own in self.letters:
            n += np.bitwise_count(_filled(own[a] ^ own[b]))
        return n == 1

    def _inserted(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Beyond the first difference, the shorter word's letters are one further on in the longer one."""
        fine, met = np.ones(len(a), dtype=bool), np.zeros(len(a), dtype=bool)
        for own, on in zip(self.letters, self.letters_on, strict=True):
            apart, beyond = own[a] ^ own[b], on[a] ^ own[b]
            lowest = np.bitwise_count((apart & -apart) - np.uint64(1)).astype(np.uint64) & np.uint64(56)
            fine &= np.where(met, beyond == 0, (apart == 0) | (beyond >> lowest == 0))
            met |= apart != 0
        return fine


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in one row, and the length of each value."""
    own = column.combine_chunks()
    offsets = np.frombuffer(own.buffers()[1], dtype=np.int32)[own.offset:own.offset + len(own) + 1]
    return np.frombuffer(own.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]], np.diff(offsets)


def _width(length: np.ndarray) -> int:
    return (int(length.max()) // 8 + 1) * 8


def _links(units: DataFrame) -> DataFrame:
    """word, near, near_n for both words of each pair, possibly repeated."""
    import pyarrow as pa
    unit = ("key", "left", "right")

    def found(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        """begin: where units begin."""
        if len(begin) > 1 and table.num_rows * _width(_bytes(table["letters"])[1]) > CELLS:
            middle = len(begin) // 2
            yield from found(table.slice(0, begin[middle]), begin[:middle])
            yield from found(table.slice(begin[middle]), begin[middle:] - begin[middle])
            return
        letters, n = table["letters"].combine_chunks(), table["n"].combine_chunks()
        for a, b in _Lists(table, begin).near():
            if len(a):
                word, near = np.concatenate([a, b]), np.concatenate([b, a])
                yield pa.RecordBatch.from_arrays([letters.take(pa.array(word)), letters.take(pa.array(near)), n.take(pa.array(near))],
                                                 names=["word", "near", "near_n"])

    def run(batches):
        held = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            held = own if held is None else pa.concat_tables([held, own])
            keys = np.stack([np.asarray(held[c]).astype(np.int64) for c in unit])
            begin = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
            if len(begin) > 1:  # the last unit may go on in the next batch
                yield from found(held.slice(0, begin[-1]), begin[:-1])
                held = held.slice(begin[-1])
        if held is not None and held.num_rows:
            yield from found(held, np.array([0]))

    latin = units.repartition(*unit).sortWithinPartitions(*unit, "visits").mapInArrow(run, "word binary, near binary, near_n long")
    return latin.select(F.decode("word", "ISO-8859-1").alias("word"), F.decode("near", "ISO-8859-1").alias("near"), "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root for words with a form. A form is at least TIMES as frequent, so paths have no cycle and few steps.

    Each round doubles the steps that a word has followed.
    """
    told = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = told.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(told.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        told = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return told


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = LETTERS, least: int = LEAST,
                   slips: int = SLIPS, times: int = TIMES, common: int = COMMON, block_words: int = BLOCK_WORDS,
                   block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are maximal runs of Latin letters (A-Z lowered, no other) of at least `letters` letters and `least` occurrences
    in all texts; of an occurrence whose hash of id and run is divisible by `slips`, one letter is gone first. Words are
    near if one inserted, deleted or replaced letter makes them equal. The form is the most frequent near word (of ties
    the first by code points) if it occurs at least `times` as often; the root follows forms to the last and is the word
    itself without one. Null texts hold no words; a null id hashes as an empty one; repeated rows count again; other
    columns are ignored. An empty table gives no rows.
    """
    words = staged(counted_words(docs, doc_id, text, letters, least, slips), "words")
    postings = _postings(staged(_cut(words, dictionary(words, common)), "cut-words"))
    # One exchange for both: a word has at most some hundred near words.
    links = _links(_units(postings, block_words, block_letters)).repartition("word").distinct()
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n")))
        .alias("to")), "variants")
    roots = _roots(known.filter("to is not null").select("word", "to.form"))
    return known.join(roots, "word", "left").select(
        "word", "n", "n_near", F.col("to.form").alias("form"), F.col("to.n").alias("form_n"),
        F.coalesce("root", "word").alias("root"))
