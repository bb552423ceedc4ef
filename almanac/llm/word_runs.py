"""Periodic runs of words, by longest common extensions on a harmonic grid.

A run is a stretch of words with smallest period ``q`` that has at least ``exponent * q`` words
(and ``least`` words) and that neither neighbour extends. Its places ``i`` with word ``i`` equal to
word ``i + q`` are consecutive and at least ``max(least, exponent * q) - q`` in number, so a grid of
that step meets each run of period ``q`` at least once; all grids together have about
``n ln n / (exponent - 1)`` places. Behind each place where the two words agree, the longest common
extensions of ``i`` and ``i + q`` to both sides give the whole stretch.

Extensions come from a difference cover: only suffixes whose place is in the cover modulo
``MODULUS`` are sorted. Any two places reach two sampled ones by the same shift below ``MODULUS``;
the words up to there are compared, the rest is a minimum over the common prefixes of neighbouring
sampled suffixes, kept in a sparse table. The same structure over the reversed words extends to the
left. Everything is done for the documents of a slice at once; suffixes of different
documents are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from almanac.session import ship_package

MODULUS = 31
WORDS_AT_ONCE = 200_000
PLACES_AT_ONCE = 1_000_000
RUNS = "array<struct<start: long, length: long, period: long>>"


def difference_cover(modulus: int) -> list[int]:
    """A set of least size whose differences are all residues, by depth-first search."""

    def search(chosen: list[int], size: int) -> list[int] | None:
        if len(chosen) == size:
            differences = {(a - b) % modulus for a in chosen for b in chosen}
            return chosen if len(differences) == modulus else None
        for x in range(chosen[-1] + 1, modulus):
            found = search(chosen + [x], size)
            if found:
                return found
        return None

    size = 1
    while size * (size - 1) + 1 < modulus:
        size += 1
    while True:
        found = search([0], size)
        if found:
            return found
        size += 1


COVER = np.array(difference_cover(MODULUS))
#: The sampled places at or before each residue, less one; the shift that syncs two residues.
PLACE_IN_COVER = np.searchsorted(COVER, np.arange(MODULUS))
_SAMPLED = np.isin((np.arange(MODULUS)[:, None] + np.arange(MODULUS)) % MODULUS, COVER)
SHIFT = np.argmax(_SAMPLED[:, None, :] & _SAMPLED[None, :, :], axis=2)


def _sample(places: np.ndarray) -> np.ndarray:
    """The number of a sampled place among all sampled places."""
    return places // MODULUS * len(COVER) + PLACE_IN_COVER[places % MODULUS]


class Extensions:
    """Longest common extensions to the right, within the documents of an array of word numbers.

    Words are numbers from 1. A 0 stands before the first document and behind each one.
    """

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([words, np.zeros(MODULUS, words.dtype)])
        rounds = np.arange(0, len(words), MODULUS)
        self.places = (rounds[:, None] + COVER).ravel()
        self.places = self.places[self.places < len(words)]
        before = np.cumsum(words == 0)
        document = (before - (words == 0))[self.places]
        self._sort(document)
        self._common_prefixes(document)
        self._minima(document)

    def _sort(self, document: np.ndarray) -> None:
        """Order the sampled suffixes of each document: first by ``MODULUS`` words, then doubling.

        ``name`` is the first slot of the suffixes that agree so far. ``base`` says behind how many
        words the suffixes of a slot and the one before it parted, ``level`` by which name.
        """
        n = len(self.places)
        self.order = np.arange(n)
        self.base = np.zeros(n, np.int64)
        self.level = np.full(n, -1, np.int8)
        first = np.concatenate([[True], document[1:] != document[:-1]])
        name = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        active = np.flatnonzero(~first | np.concatenate([~first[1:], [False]]))
        bits = max(1, int(self.words.max()).bit_length())
        self.packed = max(1, min(MODULUS, (63 - n.bit_length()) // bits))
        compared = 0
        while compared < MODULUS and len(active):
            at = self.places[self.order[active]]
            key = name[self.order[active]]
            for step in range(compared, min(MODULUS, compared + self.packed)):
                key = key << bits | self.words[at + step]
            active = self._part(name, active, key, compared, -1)
            compared += self.packed
        self.names = [name.copy()]
        length = MODULUS
        while len(active):
            own = self.order[active]
            other = self.names[-1][_sample(self.places[own] + length)]
            active = self._part(name, active, name[own] << n.bit_length() | other, length,
                                len(self.names) - 1)
            self.names.append(name.copy())
            length *= 2
        self.rank = name

    def _part(self, name, active, key, base: int, level: int) -> np.ndarray:
        """Sort the active slots by ``key``, whose lead is the name, and give the new names."""
        by = np.argsort(key, kind="stable")
        key = key[by]
        own = self.order[active][by]
        self.order[active] = own
        new = np.concatenate([[True], key[1:] != key[:-1]])
        slots = active[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        parted = active[new & (slots != name[own])]
        self.base[parted] = base
        self.level[parted] = level
        name[own] = slots
        alone = new & np.concatenate([new[1:], [True]])
        return active[~alone]

    def _common_prefixes(self, document: np.ndarray) -> None:
        """The common prefix of each slot's suffix and the one before it; 0 across documents."""
        self.prefix = np.zeros(len(self.order), np.int32)
        slot = np.arange(1, len(self.order))
        slot = slot[document[self.order[1:]] == document[self.order[:-1]]]
        one, two = self.places[self.order[slot - 1]], self.places[self.order[slot]]
        common = self.base[slot].copy()
        for level in range(len(self.names) - 1, -1, -1):
            deep = np.flatnonzero(self.level[slot] >= level)
            a, b = one[deep] + common[deep], two[deep] + common[deep]
            same = self.names[level][_sample(a)] == self.names[level][_sample(b)]
            common[deep[same]] += MODULUS << level
        rest = np.arange(len(slot))
        while len(rest):
            same = self.words[one[rest] + common[rest]] == self.words[two[rest] + common[rest]]
            rest = rest[same]
            common[rest] += 1
        self.prefix[slot] = common

    def _minima(self, document: np.ndarray) -> None:
        most = int(np.bincount(document).max())
        self.minima = [self.prefix]
        width = 1
        while 2 * width <= most:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least common prefix of the slots behind ``low`` up to ``high``."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            table = self.minima[k]
            out[of] = np.minimum(table[low[of] + 1], table[high[of] + 1 - (1 << int(k))])
        return out

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """How many words agree from two different places of one document."""
        shift = SHIFT[one % MODULUS, two % MODULUS]
        out = np.zeros(len(one), np.int64)
        rest = np.arange(len(one))
        done = 0
        while True:
            synced = rest[shift[rest] == done]
            if len(synced):
                a = self.rank[_sample(one[synced] + done)]
                b = self.rank[_sample(two[synced] + done)]
                out[synced] = done + self._least(np.minimum(a, b), np.maximum(a, b))
            rest = rest[shift[rest] > done]
            if not len(rest):
                return out
            out[rest] = done
            rest = rest[self.words[one[rest] + done] == self.words[two[rest] + done]]
            done += 1


def _grid_places(starts: np.ndarray, sizes: np.ndarray, least: int,
                 exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(place, period)`` of all grids of all documents, so many at once, least periods first."""
    tops = np.where(sizes >= least, sizes // exponent, 0)
    top = int(tops.max(initial=0))
    wide = np.argsort(-tops, kind="stable")
    with_period = np.searchsorted(-tops[wide], -np.arange(1, top + 1), side="right")
    held: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        places, periods = zip(*held)
        return np.concatenate(places), np.concatenate(periods)

    for period in range(1, top + 1):
        step = max(least, exponent * period) - period
        documents = wide[:with_period[period - 1]]
        counts = -(-(sizes[documents] - period) // step)
        of = np.repeat(np.arange(len(documents)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        held.append((starts[documents][of] + nth * step, np.full(len(of), period)))
        total += len(of)
        if total >= PLACES_AT_ONCE:
            yield flush()
            held, total = [], 0
    if held:
        yield flush()


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = 6,
              exponent: int = 4) -> np.ndarray:
    """``(start, length, period)`` of all runs, by start and period, as places in ``words``.

    ``words`` is laid out as for ``Extensions``; ``starts`` and ``sizes`` tell the documents in
    it.
    """
    found = [np.empty((0, 3), np.int64)]
    right = left = None
    last = len(words) - 1
    for place, period in _grid_places(starts, sizes, least, exponent):
        same = np.flatnonzero(words[place] == words[place + period])
        if not len(same):
            continue
        if right is None:
            right, left = Extensions(words), Extensions(words[::-1])
        place, period = place[same], period[same]
        ahead = right.common(place, place + period)
        behind = left.common(last - (place + period - 1), last - (place - 1))
        length = behind + ahead + period
        long = length >= np.maximum(least, exponent * period)
        rows = np.stack([(place - behind)[long], length[long], period[long]], axis=1)
        # A stretch that comes with several periods has the least of them; the others are multiples.
        found = [_least_periods(np.concatenate(found + [rows]))]
    runs = found[0]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _least_periods(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


class _Numbers(dict):
    """Words to numbers from 1, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def _slice_runs(texts: list[list[bytes]], least: int, exponent: int) -> list[np.ndarray]:
    """The runs of each document, places counted from its first word."""
    numbers = _Numbers()
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes
    words = np.zeros(int(ends[-1]) + 1, np.int64)
    for at, text in zip(starts.tolist(), texts):
        if text:
            words[at:at + len(text)] = list(map(numbers.__getitem__, text))
    runs = find_runs(words, starts, sizes, least, exponent)
    cuts = np.searchsorted(runs[:, 0], starts[1:])
    runs[:, 0] -= starts[np.searchsorted(starts, runs[:, 0], side="right") - 1]
    return np.split(runs, cuts)


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside of repetitions: each run keeps its first period."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        words = [words[i] for i in kept.tolist()]
    return b" ".join(words)


def word_runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    Words are what stands between ASCII white space, numbered from 0; ``runs`` are
    ``(start, length, period)`` by start and period, and ``collapsed`` is the text's words, joined
    by one space, without those that a run has behind its first period. ``exponent`` is two or
    more. A null or empty text has no words, no runs and an empty ``collapsed``. Rows are
    independent: repeated and null ids have a result for each row. Other columns play no part. A
    text is worked on in one piece; memory goes with the words of a slice, or of one longer text.
    """
    if exponent < 2:
        raise ValueError("a run has two periods or more")
    ship_package(docs.sparkSession)

    def result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _slice_runs(texts, least, exponent)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        flat = np.concatenate(runs)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])),
            pa.array(list(map(_collapsed, texts, runs)), pa.binary()).view(pa.string()),
        ], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, total = [], [], 0
            for row in range(batch.num_rows):
                ids.append(batch.column(0)[row].as_py())
                texts.append((batch.column(1)[row].as_py() or b"").split())
                total += len(texts[-1])
                if total >= WORDS_AT_ONCE:
                    yield result(ids, texts)
                    ids, texts, total = [], [], 0
            if ids:
                yield result(ids, texts)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as binary) as text").mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
