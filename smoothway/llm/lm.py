"""Language-model scores: stupid backoff over n-gram counts of a corpus.

An entry is an n-gram of a document: its context (the words before its last) and its last word, the two
as 64-bit hashes, and how often the document has it. A task packs its entries by bucket, and Spark deals the
packs, so the counts of an n-gram and of its context meet in one place, which sorts arrays of about PACKED
entries. A context too frequent for one place is spread over several, each of which gets its sums. What has
no count goes on to a shorter context, for which the corpus' n-grams are counted before they are packed. Single
words aren't: a word is as often a context of one word as it is there, if the ends of texts follow words too.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smoothway.llm.store import discard, written

ORDER, BACKOFF = 3, 0.4
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A byte that is none of a word; bytes that are hashed together; the polynomial's number.
GAP, PIECE, KEY = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 1 << 15, 0x9E3779B97F4A7C15
#: What stands before the first word of a text and after its last, as hashes; the number by which contexts are mixed.
START, END, MIX = np.uint64(0x5851F42D4C957F2D), np.uint64(0xD1342543DE82EF95), 0x9FB21C651E98DF25
#: Parts of the contexts that are dealt one after another; each needs so much less room on disk.
SLICES = 3
LOW = 0x7FFFFFFF
#: A context with more rows than this, or than this share of all rows, is too frequent for one place.
MOST_ROWS, OFTEN = 4_000_000, 0.001
#: Counters by which frequent contexts are found, and one text in so many that is looked at for that.
SLOTS, LOOKED_AT = 1 << 16, 16
#: The context of no words, as a hash.
NOTHING = 1
#: Rows in a batch that a task hands to Spark.
BATCH = 1 << 19
#: Entries that a task packs at once, and that a bucket has about; buckets over which a frequent context is spread.
PACKED, SPREAD = 1 << 20, 64
#: Logarithms are whole numbers of this unit, so that sums don't depend on the order of rows.
UNIT = 1e-9


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte (0: none of a word, A-Z as a-z), and the powers of KEY and of its inverse."""
    rng = np.random.default_rng(11)
    value = rng.integers(1, 1 << 63, size=256, dtype=np.uint64)
    value[[b for b in range(128) if not WORD.match(bytes([b]))]] = 0
    value[65:91] = value[97:123]
    powers = [np.concatenate([np.ones(1, dtype=np.uint64), np.full(2 * PIECE - 1, k, dtype=np.uint64)]) for k in (KEY, pow(KEY, -1, 1 << 64))]
    return value, *(np.cumprod(p, dtype=np.uint64) for p in powers)


def _hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and how many each text has.

    A word's hash is a polynomial of its bytes' numbers. Texts are hashed together, piece by piece: sums of
    all bytes up to each place give every word's polynomial as a difference, brought back to power 0.
    """
    value, up, down = _hashed.tables = getattr(_hashed, "tables", None) or _tables()
    whole = b"\0".join(t or b"" for t in texts) + b"\0"
    hashes, firsts, at = [], [], 0
    while at < len(whole):
        to = GAP.search(whole, min(at + PIECE, len(whole)) - 1).end()
        part = np.frombuffer(whole, dtype=np.uint8, count=to - at, offset=at)
        if len(part) > len(up):  # a word longer than a piece
            up, down = (np.concatenate([p, np.full(len(part) - len(p), p[1], dtype=np.uint64)]) for p in (up, down))
            up[2 * PIECE :], down[2 * PIECE :] = up[2 * PIECE - 1] * np.cumprod(up[2 * PIECE :], dtype=np.uint64), down[2 * PIECE - 1] * np.cumprod(down[2 * PIECE :], dtype=np.uint64)
        known = value.take(part)
        within = known != 0
        edge = np.flatnonzero(np.concatenate([within[:1], within[1:] != within[:-1]]))
        start, end = edge[::2], edge[1::2]
        known *= up[: len(part)]
        sums = np.cumsum(known, out=known)
        x = sums.take(end - 1)
        x -= np.where(start > 0, sums.take(start - 1), 0)  # at -1 the last, which isn't used
        x *= down.take(start)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        hashes.append(x ^ x >> np.uint64(32))
        firsts.append(start + at)
        at = to
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    sizes = np.diff(np.searchsorted(np.concatenate(firsts), ends) if firsts else np.zeros(len(texts), dtype=np.int64), prepend=0)
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), sizes


def _contexts(words: np.ndarray, sizes: np.ndarray, order: int) -> np.ndarray:
    """The hash of the order - 1 words before each word; before a text's first word is its start."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    place = np.arange(len(words)) - np.repeat(starts, sizes[sizes > 0])
    out = np.full(len(words), order, dtype=np.uint64)
    for back in range(order - 1, 0, -1):
        before = np.where(place >= back, np.roll(words, back), START)
        out = (out ^ before) * np.uint64(MIX)
        out ^= out >> np.uint64(32)
    return out


def _last(context: np.ndarray) -> np.ndarray:
    """The words that contexts of one word are, from their hashes."""
    return (context ^ context >> np.uint64(32)) * np.uint64(pow(MIX, -1, 1 << 64)) ^ np.uint64(2)


def _slot(context: np.ndarray) -> np.ndarray:
    return (context >> np.uint64(48)).astype(np.int64)


def _tally(rows: DataFrame, orders: Iterable[int]) -> DataFrame:
    """How many n-grams each slot of contexts (what: order) and of n-grams (what: -order) has, in one text of LOOKED_AT."""
    orders = list(orders)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {what: np.zeros(SLOTS, dtype=np.int64) for k in orders for what in (k, -k)}
        for batch in batches:
            words, sizes = _hashed(batch.column(0).cast(pa.binary()).to_pylist())
            for k in orders:
                context = _contexts(words, sizes, k)
                counts[k] += np.bincount(_slot(context), minlength=SLOTS)
                counts[-k] += np.bincount(_slot(_gram(context, words)), minlength=SLOTS)
        for what, n in counts.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), what, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["what", "slot", "n"])

    looked = rows.filter(F.pmod(F.xxhash64("row", "text", F.lit(11)), F.lit(LOOKED_AT)) == 0).select("text")
    return looked.mapInArrow(tally, "what int, slot int, n long").groupBy("what", "slot").agg(F.sum("n").alias("n"))


def _frequents(rows: DataFrame, orders: Iterable[int]) -> tuple[dict[int, tuple[int, ...]], int]:
    """Slots of contexts and n-grams that may be too frequent for one place, by order and -order, at most SLOTS
    each; and about how many words there are.

    Looked for in one text of LOOKED_AT, as range partitioning does, since it only decides where
    rows go: the counts cover all rows and are the same whatever is found here.
    """
    orders = list(orders)
    found = written(_tally(rows, orders), "lm-slots")
    whole = found.filter(F.col("what") == orders[0]).agg(F.sum("n")).first()[0] or 0
    least = max(min(MOST_ROWS / LOOKED_AT, whole * OFTEN) / 2, 4 * whole / SLOTS)
    slots = {what: () for k in orders for what in (k, -k)}
    for r in found.filter(F.col("n") > least).collect():
        slots[r["what"]] += (r["slot"],)
    discard(found)
    return {what: tuple(sorted(found)) for what, found in slots.items()}, whole * LOOKED_AT


def _frequent(rows: DataFrame, order: int) -> tuple[int, ...]:
    """Slots of contexts of one order that may be too frequent for one place."""
    return _frequents(rows, [order])[0][order]


def gram_rows(rows: DataFrame, order: int, part: int | None, parts: int, frequent: tuple[int, ...] | None, summed: bool = False) -> DataFrame:
    """Rows (row, context, word, times, c...) of all n-grams of a part of the contexts, part None for the
    frequent ones (all, if these are None). times is how often the text has one, below 0 where the text isn't
    known, as it then doesn't count.

    For texts that aren't known, c2 and so on are the contexts of n-grams of two words and more; others never
    need them. With summed only known texts matter, and a row has the sum of many (row is null).
    """
    less = [] if summed else list(range(2, order))
    names = ["row", "context", "word", "times", *[f"c{k}" for k in less]]
    kind = "row long, context long, word long, times int" + "".join(f", c{k} long" for k in less)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.full(SLOTS, frequent is None)
        often[list(frequent or ())] = True
        for batch in batches:
            words, sizes = _hashed(batch.column(1).cast(pa.binary()).to_pylist())
            context, row = _contexts(words, sizes, order), np.repeat(batch.column(0).to_numpy(), sizes)
            known = np.repeat(batch.column(2).to_numpy(zero_copy_only=False), sizes)
            at = often[_slot(context)]
            at = np.nonzero((at if part is None else ~at & ((context & np.uint64(LOW)).astype(np.int64) % parts == part)) & (known | (not summed)))[0]
            key = (context[at] * np.uint64(0x9E3779B97F4A7C15) ^ words[at]) * np.uint64(0x9FB21C651E98DF25)
            if not summed:
                key ^= row[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            at = at[first]
            fewer = [_contexts(words, sizes, k).view(np.int64) for k in less]
            for k in range(0, len(at), BATCH):
                i, n = at[k : k + BATCH], times[k : k + BATCH].astype(np.int32)
                own = known[i]
                out = [pa.nulls(len(i), pa.int64()) if summed else pa.array(row[i]), pa.array(context[i].view(np.int64)), pa.array(words[i].view(np.int64)), pa.array(np.where(own, n, -n))]
                yield pa.RecordBatch.from_arrays([*out, *[pa.array(c[i], mask=own) for c in fewer]], names=names)

    return rows.select("row", "text", "known").mapInArrow(explode, kind)


class _Deal:
    """Where the entries of an order go. An entry is (row, context, word, times, shorter contexts...): an n-gram of
    a text, which counts if times is above 0; of no text (row COUNT) it only counts.

    A context's entries lie in one bucket. Those of a frequent one are spread over several by n-gram, those of a
    frequent n-gram by row; what a bucket then can't count for itself, each of them gets as a sum.
    """

    def __init__(self, order: int, slots: dict[int, tuple[int, ...]], buckets: int, parts: int):
        self.order, self.buckets, self.parts = order, min(buckets, 1 << 20), parts
        self.times = np.dtype(np.int32 if order > 1 else np.int64)  # counts of words come as sums
        self.spread = min(self.buckets, SPREAD) if order > 1 else self.buckets
        self.often, self.grams = np.full(SLOTS, order == 1), np.zeros(SLOTS, dtype=bool)
        self.often[list(slots[order])] = self.grams[list(slots[-order])] = True

    def part(self, context: np.ndarray) -> np.ndarray:
        return _of(context & np.uint64(0xFFFF), self.parts, 16)

    def _everywhere(self, row: int, key: np.ndarray, context: np.ndarray, word: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sums by key, as entries for all buckets over which their contexts are spread."""
        place, new = _groups(key)
        at, n = np.repeat(place[new], self.spread), np.repeat(_sums(times[place], new), self.spread)
        to = (self._home(context[at]) + np.tile(np.arange(self.spread), len(new))) % self.buckets
        return to, np.full(len(at), row), context[at], word[at], n

    def _home(self, context: np.ndarray) -> np.ndarray:
        return _of(context >> np.uint64(16) & np.uint64(0xFFFFFFFF), self.buckets, 32)

    def packed(self, part: int, row: np.ndarray, context: np.ndarray, word: np.ndarray, times: np.ndarray, *less: np.ndarray) -> pa.RecordBatch:
        """The entries of a part of the contexts as a row for each bucket; equal ones become one."""
        gram, to = _gram(context, word), self._home(context)
        hot = np.flatnonzero(self.often[_slot(context)])
        if len(hot):
            by, most = gram[hot], self.grams[_slot(gram[hot])]
            by = np.where(most, row[hot].astype(np.uint64) * np.uint64(KEY) >> np.uint64(32), by >> np.uint64(8) & np.uint64(0xFFFFFFFF))
            to[hot] = (to[hot] + _of(by, self.spread, 32)) % self.buckets
            counts = times[hot] > 0
            at = hot[counts & (word[hot] != END)]
            added = [self._everywhere(WHOLE, context[at], context[at], np.zeros(len(at), dtype=np.uint64), times[at])]
            at = hot[counts & most]
            added.append(self._everywhere(COUNT, gram[at], context[at], word[at], times[at]))
            at = hot[most]
            times = times.copy()
            times[at] = -np.abs(times[at])
            stay = np.ones(len(row), dtype=bool)
            stay[at[row[at] < 0]] = False
            to, row, context, word, times = (np.concatenate([c[stay], *[x[k] for x in added]]) for k, c in enumerate((to, row, context, word, times)))
            more = sum(len(x[0]) for x in added)
            gram, less = np.concatenate([gram[stay], _gram(context[len(context) - more :], word[len(word) - more :])]), [np.concatenate([c[stay], np.zeros(more, dtype=np.uint64)]) for c in less]
        key = to.astype(np.uint64) << np.uint64(44) | (row.astype(np.uint64) & np.uint64(0xFFFFF)) << np.uint64(24) | gram >> np.uint64(40)
        place = np.argsort(key)
        new = np.flatnonzero(_differ(key[place]) | _differ(row[place]) | _differ(gram[place]))
        times, at = _sums(times[place], new).astype(self.times), place[new]
        to, row, context, word, *less = (c[at] for c in (to, row, context, word, *less))
        edge = np.flatnonzero(_differ(to))
        packs, ends = [], np.append(edge[1:], len(to))[: len(edge)]
        for a, b in zip(edge, ends, strict=True):
            asked = np.flatnonzero(times[a:b] < 0) + a
            packs.append(b"".join([c[a:b].tobytes() for c in (row, context, word, times)] + [c[asked].tobytes() for c in less]))
        return _batch(part, to[edge], ends - edge, packs)

    def unpacked(self, n: int, pack: bytes) -> list[np.ndarray]:
        row, context, word = (np.frombuffer(pack, dtype=t, count=n, offset=8 * n * k) for k, t in enumerate((np.int64, np.uint64, np.uint64)))
        times = np.frombuffer(pack, dtype=self.times, count=n, offset=24 * n)
        less = np.zeros((max(0, self.order - 2), n), dtype=np.uint64)
        if len(less):
            less[:, times < 0] = np.frombuffer(pack, dtype=np.uint8, offset=(24 + self.times.itemsize) * n).copy().view(np.uint64).reshape(len(less), -1)
        return [row, context, word, times.astype(np.int64), *less]


#: Rows of entries that count n-grams of no text, and of sums of all n-grams of a context.
COUNT, WHOLE = -1, -2
#: A row for each bucket: entries of a part of the contexts, or sums of texts (part SUMS).
SUMS, KIND = -1, "part int, bucket int, n int, pack binary"


def _batch(part: int, bucket: np.ndarray, n: np.ndarray, packs: list[bytes]) -> pa.RecordBatch:
    columns = [np.full(len(bucket), part, dtype=np.int32), bucket.astype(np.int32), n.astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(packs, type=pa.binary())], names=["part", "bucket", "n", "pack"])


def _gram(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (context * np.uint64(0x9E3779B97F4A7C15) ^ word) * np.uint64(0x9FB21C651E98DF25)
    return x ^ x >> np.uint64(32)


def _of(number: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """In which of some parts a number of so many bits lies, if all parts are as wide."""
    return (number * np.uint64(parts) >> np.uint64(bits)).astype(np.int64)


def _differ(values: np.ndarray) -> np.ndarray:
    """Which values differ from the one before; the first does."""
    return np.concatenate([np.ones(min(1, len(values)), dtype=bool), values[1:] != values[:-1]])


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys, and where in it each key is first."""
    place = np.argsort(key)
    return place, np.flatnonzero(_differ(key[place]))


def _sums(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, new) if len(new) else values[:0]


def _packs(rows: DataFrame, deal: _Deal, part: int, summed: bool) -> DataFrame:
    """Entries of the texts' n-grams of a part of the contexts, packed by bucket; with summed only counts of known texts.
    Those of two words also count the ends of known texts."""
    k = deal.order
    less = [] if summed else list(range(k - 1, 1, -1))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            words, sizes = _hashed(batch.column(1).cast(pa.binary()).to_pylist())
            context = _contexts(words, sizes, k) if k > 1 else np.full(len(words), NOTHING, dtype=np.uint64)
            knows = batch.column(2).to_numpy(zero_copy_only=False)
            known = np.repeat(knows, sizes)
            here = known if summed else np.ones(len(words), dtype=bool)
            at = np.flatnonzero(here & (deal.part(context) == part) if deal.parts > 1 else here)
            row = np.full(len(at), COUNT) if summed else np.repeat(batch.column(0).to_numpy(), sizes)[at]
            held.append((row, context[at], words[at], np.where(known[at], 1, -1), *[_contexts(words, sizes, c)[at] for c in less]))
            if k == 2:
                last = _contexts(np.append(words, START), np.array([len(words) + 1]), 2)[np.cumsum(sizes)[knows & (sizes > 0)]]
                last = last[deal.part(last) == part]
                held.append((np.full(len(last), COUNT), last, np.full(len(last), END), np.ones(len(last), dtype=np.int64)))
                size += len(last)
            size += len(at)
            if size >= PACKED:
                yield deal.packed(part, *(np.concatenate(c) for c in zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield deal.packed(part, *(np.concatenate(c) for c in zip(*held, strict=True)))

    texts = rows.filter("known") if summed else rows
    return texts.select("row", "text", "known").mapInArrow(explode, KIND)


def _met(packs: DataFrame, deal: _Deal, after: _Deal | None, lost: int, backoff: float, homes: int) -> DataFrame:
    """Of each text's n-grams that have a count: sums of their scores and how many there are, packed by the text's
    home, one of some buckets. The others as entries of the order after this one, of which the order of single words
    also gets its counts, as those of contexts; of the last order all have a count."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for b in batches:
            for n, pack, bucket in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(deal.unpacked(n, pack))
        if not held:
            return
        row, context, word, times, *less = (np.concatenate(c) for c in zip(*held, strict=True))
        del held
        gram = _gram(context, word)
        place, new = _groups(gram)
        first, own = place[new], times[place]
        total = row[place] == WHOLE
        n, whole = _sums(np.where(total, 0, np.maximum(own, 0)), new), _sums(np.where(total, own, 0), new)
        of_first = context[first]
        often = deal.often[_slot(of_first)]
        by, start = _groups(of_first)
        size = np.diff(np.append(start, len(by)))
        share = np.where(word[first] == END, 0, np.where(often, whole, n))[by]
        of = np.empty(len(first), dtype=np.int64)
        of[by] = np.repeat(_sums(share, start), size)
        score = _units(n) - _units(of) + lost * int(_units(np.array(backoff)))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(place))))
        asked = row[place] >= 0
        met = asked & (n > 0)[group] if after else asked
        at, group = place[met], group[met]
        sums = _by_row([row[at], score[group] * np.abs(times[at]), np.abs(times[at])])
        to = _home_of(sums[0], homes)
        by_home, home = _groups(to)
        ends = np.append(home[1:], len(to))[: len(home)]
        yield _batch(SUMS, to[by_home[home]], ends - home, [b"".join(c[by_home[a:z]].tobytes() for c in sums) for a, z in zip(home, ends, strict=True)])
        if not after:
            return
        at = place[asked & ~met]
        if after.order == 1:
            elsewhere = often & deal.grams[_slot(gram[first])] & (deal._home(of_first) != bucket)  # each of some buckets has these counts
            words, times_of = _last(of_first[by[start]]), _sums(np.where(elsewhere, 0, n)[by], start)
            is_word = np.flatnonzero((times_of > 0) & (words != START))
            count = len(is_word)
            yield after.packed(0, np.append(row[at], np.full(count, COUNT)), np.full(len(at) + count, NOTHING, dtype=np.uint64), np.append(word[at], words[is_word]), np.append(-np.abs(times[at]), times_of[is_word]))
            return
        shorter = less[0][at]
        parts = after.part(shorter)
        for p in range(after.parts):
            i = parts == p
            if i.any():
                yield after.packed(p, row[at[i]], shorter[i], word[at[i]], -np.abs(times[at[i]]), *[c[at[i]] for c in less[1:]])

    return packs.repartitionById(deal.buckets, F.col("bucket")).select("n", "pack", "bucket").mapInArrow(meet, KIND)


def _home_of(row: np.ndarray, homes: int) -> np.ndarray:
    return (row.astype(np.uint64) * np.uint64(KEY) >> np.uint64(32)).astype(np.int64) % homes


def _by_row(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of the columns after the first by the first."""
    place, new = _groups(columns[0])
    return [columns[0][place[new]], *[_sums(c[place], new) for c in columns[1:]]]


def _added(packs: DataFrame, homes: int) -> DataFrame:
    """Rows (row, score, n_tokens) of packed sums; a task holds those of the texts that are at home there."""
    names = ["row", "score", "n_tokens"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, PACKED
        for b in batches:
            for n, pack in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append(np.frombuffer(pack, dtype=np.int64).reshape(len(names), n))
                size += n
                if size > most:
                    held = [np.array(_by_row(list(np.concatenate(held, axis=1))))]
                    size = held[0].shape[1]
                    most = size + PACKED
        if held:
            sums = _by_row(list(np.concatenate(held, axis=1)))
            for k in range(0, len(sums[0]), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + BATCH]) for c in sums], names=names)

    return packs.repartitionById(homes, F.col("bucket")).select("n", "pack").mapInArrow(add, ", ".join(f"{c} long" for c in names))


def _units(n: np.ndarray) -> np.ndarray:
    return np.rint(np.log(np.where(n > 0, n, 1)) / UNIT).astype(np.int64)


def backoff_scores(docs: DataFrame, corpus: DataFrame | None = None, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF, slices: int = SLICES) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_backed_off, log_prob, perplexity.

    The model counts every n-gram of the documents for which learn is true, or of corpus (of all docs
    where neither is given), whatever its count. A word's score is the share of its n-gram of order
    words among all n-grams of the same context; a text starts after order - 1 start signs. Where the
    model hasn't the n-gram, the context loses its first word, at the cost of a factor backoff, down to
    the word's share of all words; a word that it doesn't have counts as one in them all. n_backed_off
    is the number of words that lost a part of their context. Null and empty texts have 0 words,
    log_prob 0 and no perplexity. Repeated rows and ids are documents of their own, null ids too; a
    null learn is false; an empty table gives no rows; other columns are not looked at.
    """
    own = F.lit(corpus is None) if learn is None else F.coalesce(learn, F.lit(False))
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), own.alias("known"))
    rows = written(read, "lm-rows", "zstd")
    if corpus is not None:  # its texts come without a row, so they are counted and never scored
        rows = rows.unionByName(written(corpus.select(F.lit(-1).cast("long").alias("row"), F.lit(None).cast(docs.schema[doc_id].dataType).alias("doc_id"), F.col(text).alias("text"), F.lit(True).alias("known")), "lm-corpus", "zstd"))
    deals = {}
    slots, words = _frequents(rows, range(order, 0, -1))
    for k in range(1, order + 1):
        parts = slices if k > 1 else 1
        deals[k] = _Deal(k, slots, max(docs.sparkSession.sparkContext.defaultParallelism, -(-words // (parts * PACKED))), parts)
    homes = max(docs.sparkSession.sparkContext.defaultParallelism, -(-words // (4 * PACKED)))  # each reads some 100 MB of packs
    left, sums, before = None, [], []
    for k in range(order, 0, -1):
        if left is not None and left.isEmpty():
            break
        scored = []
        for part in range(deals[k].parts):
            packs = [] if left is None else [left.filter(F.col("part") == part)]
            if left is None or k > 1:  # counts of single words are among what is left
                packs.append(_packs(rows, deals[k], part, summed=left is not None))
            scored.append(written(_met(reduce(DataFrame.unionByName, packs), deals[k], deals.get(k - 1), order - k, backoff, homes), "lm-scored"))
        found = reduce(DataFrame.unionByName, scored)
        added = _added(found.filter(F.col("part") == SUMS), homes)
        sums.append(written(added.withColumn("backed", F.col("n_tokens") if k < order else F.lit(0).cast("long")), "lm-sums"))
        left = found.filter(F.col("part") != SUMS)
        discard(*before)
        before = scored
    discard(*before)
    totals = [F.sum(c).alias(c) for c in ("score", "backed", "n_tokens")]
    whole = reduce(DataFrame.unionByName, sums).groupBy("row").agg(*totals)
    found = rows.filter("row >= 0").drop("text", "known").join(whole, "row", "left").fillna(0, ["score", "backed", "n_tokens"])
    log_prob = F.col("score") * UNIT
    return found.select(F.col("doc_id").alias(doc_id), "n_tokens", F.col("backed").alias("n_backed_off"), F.round(log_prob, 6).alias("log_prob"), F.when(F.col("n_tokens") > 0, F.round(F.exp(-log_prob / F.col("n_tokens")), 6)).alias("perplexity"))
