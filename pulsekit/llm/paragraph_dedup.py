"""Operator 6: near-duplicate paragraph removal by MinHash banding and components.

A paragraph is a line of a text, of any length; a line of more than
``LONG_WORDS`` words is also cut into pieces after sentence ends whose last two
words hash to 0 mod 4, so that a passage inside a long line is cut the same way
wherever it appears. Lines and pieces of at least ``MIN_WORDS`` words are
compared as sets of five-word shingles: bands tuned for recall pick candidates,
the whole sets decide (Jaccard of 0.8 or more), and components of the links are
the classes. Of every class the one with the least (doc_id, position) stays; all
others are removed, repeats within one document included. Lines go first, then
the pieces of the lines that are left (an uncut line is its own piece).

Last, passages inside or across lines, with or without sentence ends: windows of
``WINDOW`` words at content-anchored places bring equal stretches together, so
that every passage of 50 words has one, and around a window that comes up again
all stretches of ``PASSAGE`` words that hold it are compared. Of equal stretches
the first stays, so a passage of 50 equal words or more is cut from end to end.

Band hashes and unit ids are shuffled first, packed by remainders of the key (16 and 8
bytes each), and met in order one remainder at a time; rows with places are made only
for ids that come up again or have a similar one, which a bitmap of at most
``2**FILTER_BITS`` bits tells in advance (it may let others pass, never stop one).

Defined results: null and empty texts have no paragraphs and are kept as they
are (null stays null); lines under ``MIN_WORDS`` words are never removed;
a passage of fewer than 50 words that is no line or piece stays; very long texts are handled
whole, in memory proportional to them; documents with equal doc_id are told apart
by their text, and of rows equal in both all count as one document; ties go to the
least (doc_id, text hash, position); a null doc_id sorts first; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm import neardup as ND
from pulsekit.llm import textarrays as TA
from pulsekit.llm.storage import discard, saved

MIN_WORDS = 20
LONG_WORDS = 60
# Windows start at the least word 5-gram of every ANCHOR_SPAN starts in a row, so every passage of
# ANCHOR_SPAN + WINDOW - 1 = 50 words holds a whole one, and windows in a row leave no word between them.
WINDOW = 26
ANCHOR_SPAN = 25
PASSAGE = 50
NEAR = 4096  # bytes
FILTER_BITS = 28
CHUNK_BYTES = 1 << 18  # texts handled together: their arrays stay in the cache
HELD_ROWS = 1 << 19  # keys that a task packs together
_REMEMBERED = 1 << 18
_PLACE_BITS = 30  # no string has more words
LINE, PIECE, WINDOWS = 1, 2, 4  # kinds of units, as bits: an uncut line is both of the first
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True


def _cuts(c: TA.Chunk, w: TA.Words, hashes: np.ndarray, long_words: int):
    """Line number of every word, and its piece number: long lines are cut after some sentence ends."""
    n = len(w.start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, dtype=bool)  # the first word after each newline and of each text begins a line
    cut[np.searchsorted(w.start, np.flatnonzero(c.data[:c.size] == 0x0A))] = True
    cut[w.first[w.count > 0]] = True
    cut = cut[:n]
    line = np.cumsum(cut) - 1
    after = np.flatnonzero(_ENDS[c.data[w.end[1:-1] - 1]]) + 2  # a cut may come before these words
    # not after the first word of a text: what stands before it is another text
    after = after[(w.text[after - 2] == w.text[after - 1]) & (np.bincount(line)[line[after]] > long_words)]
    pair = TA.mix(hashes[after - 1] + hashes[after - 2] * np.uint64(3))
    cut[after[pair & np.uint64(3) == 0]] = True
    return line, np.cumsum(cut) - 1


def _runs(number: np.ndarray):
    """First word and word count of each run of equal numbers."""
    count = np.bincount(number)
    return np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64), count


def _sequence_ids(h: np.ndarray, number: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hash of the word sequence of each run."""
    mult = np.uint64(0xE7037ED1A0B428DB)
    place = (np.arange(len(h)) - first[number]).astype(np.uint64)
    return TA.mix(np.add.reduceat(TA.mix(h + place * mult), first) + count.astype(np.uint64)).view(np.int64)


def _prefix_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of h[i] * M^i and the powers of 1 / M (mod 2^64), from which any stretch's hash follows."""
    mult = np.uint64(0xE7037ED1A0B428DB)
    back = np.uint64(pow(0xE7037ED1A0B428DB, -1, 1 << 64))
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), mult)]))[:len(h)]
    return (np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power)]),
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(h), back)]))[:len(h)])


def _stretch_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, words: int) -> np.ndarray:
    """Hash of the ``words`` words from each start on."""
    sums, back = prefix
    return TA.mix((sums[start + words] - sums[start]) * back[start] + np.uint64(words)).view(np.int64)


def _anchors(h: np.ndarray, text: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Words at which a window starts: minimizers among the starts whose window lies in the text."""
    starts = count - WINDOW + 1  # possible starts a text
    n = len(h)
    if n < WINDOW or (starts <= 0).all():
        return np.zeros(0, np.int64)
    g = h[:n - 4].copy()
    for j in range(1, 5):
        g = g * np.uint64(0xC2B2AE3D27D4EB4F) + h[j:n - 4 + j]
    place = np.arange(n) - first[text]
    at = np.flatnonzero(place < starts[text])
    mine = text[at]
    # rightmost least value (by its first bits) of each ANCHOR_SPAN starts in a row; a text with fewer starts is one such row
    low = np.uint64((1 << _PLACE_BITS) - 1)
    key = (TA.mix(g[at]) & ~low) | (low - np.arange(len(at), dtype=np.uint64))
    lo = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    size = np.diff(np.append(lo, len(at)))
    best = np.minimum.reduceat(key, lo)[size < ANCHOR_SPAN]
    if len(at) >= ANCHOR_SPAN:
        least, reach = key, 1  # least of `reach` starts in a row
        while reach < ANCHOR_SPAN:
            step = min(reach, ANCHOR_SPAN - reach)
            least = np.minimum(least[step:], least[:-step])
            reach += step
        best = np.concatenate([best, least[mine[ANCHOR_SPAN - 1:] == mine[:len(least)]]])
    chosen = np.zeros(len(at), dtype=bool)
    chosen[low - (best & low)] = True
    return at[chosen]


@dataclass
class _Units:
    """Compared units of a chunk, ordered by text and place; ``first`` and ``count`` are in words."""
    words: TA.Words
    hashes: np.ndarray  # of the words
    ids: np.ndarray
    kind: np.ndarray
    first: np.ndarray
    count: np.ndarray
    line: np.ndarray   # first word of the unit's line (of a window: of its text)

    @property
    def text(self) -> np.ndarray:
        return self.words.text[self.first]

    @property
    def start(self) -> np.ndarray:
        return self.words.start[self.first]

    @property
    def end(self) -> np.ndarray:
        return self.words.end[self.first + self.count - 1]

    def grams(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of the units ``at``, with the index into ``at`` of their unit."""
        n = self.count[at]
        owner = np.repeat(np.arange(len(at)), n)
        word = np.arange(len(owner)) + (self.first[at] - np.cumsum(n) + n)[owner]
        return TA.ngrams(self.hashes[word], owner, k, len(at))


def _units(c: TA.Chunk, k: int, min_words: int, long_words: int, windows: bool = False, with_grams: bool = True):
    """The units of a chunk, and the grams of its lines and pieces with the index of their unit (none if not wanted)."""
    w = TA.words_of(c)
    h = TA.word_hashes(c, w)
    none = np.zeros(0, np.int64)
    parts = []
    if len(h):
        line, piece = _cuts(c, w, h, long_words)
        lfirst, lcount = _runs(line)
        pfirst, pcount = _runs(piece)
        whole = pcount == lcount[line[pfirst]]  # pieces that are their whole line
        lkind = np.full(len(lfirst), LINE)
        lkind[line[pfirst[whole]]] = LINE | PIECE
        for number, first, count, kind, use in (
                (line, lfirst, lcount, lkind, lcount >= min_words),
                (piece, pfirst, pcount, np.full(len(pfirst), PIECE), ~whole & (pcount >= min_words))):
            if use.any():
                ids = _sequence_ids(h, number, first, count)
                parts.append((ids[use], kind[use], first[use], count[use], lfirst[line[first[use]]]))
        at = _anchors(h, w.text, w.first, w.count) if windows else none
        if len(at):
            parts.append((_stretch_hash(_prefix_hash(h), at, WINDOW), np.full(len(at), WINDOWS), at,
                          np.full(len(at), WINDOW), w.first[w.text[at]]))
    u = _Units(w, h, *([np.concatenate(x) for x in zip(*parts)] if parts else [none] * 5))
    if not with_grams or not parts:
        return u, np.zeros(0, np.uint64), none
    return u, *u.grams(np.flatnonzero(u.kind != WINDOWS), k)  # lines and pieces come first


def _keyed_rows(k, bands, rows, min_words, long_words, n_parts):
    """Per part (the key's remainder by ``n_parts``) the band hashes of lines and pieces with their ids, and the ids
    of all units (twice if they come up again within a chunk), as packed arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = ~np.arange(_REMEMBERED)  # by the last bits, the id this task sent last: copies need no second row (no id fits its slot yet)
        held, load = [], 0
        for batch in batches:
            for c in TA.text_chunks(batch.column("text"), CHUNK_BYTES):
                u = _units(c, k, min_words, long_words, True, False)[0]
                coarse = np.flatnonzero(u.kind != WINDOWS)
                _, first = np.unique(u.ids[coarse], return_index=True)
                first = np.sort(coarse[first])
                first = first[sent[u.ids[first] & (_REMEMBERED - 1)] != u.ids[first]]
                sent[u.ids[first] & (_REMEMBERED - 1)] = u.ids[first]
                h, own = ND.band_hashes(*u.grams(first, k), bands, rows)
                ids, n = np.unique(u.ids, return_counts=True)
                held.append((h.ravel(), np.repeat(u.ids[first][own], bands), np.concatenate([ids, ids[n > 1]])))
                load += len(held[-1][0]) + len(held[-1][2])
                if load >= HELD_ROWS:
                    yield ND.packed_keys(held, n_parts)
                    held, load = [], 0
        if held:
            yield ND.packed_keys(held, n_parts)
    return run


def _filter_bits(wanted: DataFrame, probes: int = 1) -> np.ndarray:
    """Bitmap of the ids, ``probes`` bits an id among 8 to 16 times as many, and at most 2**FILTER_BITS: at most
    2**(FILTER_BITS - 6) words reach the driver."""
    bits = min(FILTER_BITS, max(12, (8 * probes * wanted.count()).bit_length()))
    slots = F.explode(F.array(*[F.shiftrightunsigned("id", 32 * i).bitwiseAND((1 << bits) - 1) for i in range(probes)]))
    words = wanted.select(slots.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def _may_hold(bits: np.ndarray, ids: np.ndarray, probes: int = 1) -> np.ndarray:
    held = np.ones(len(ids), dtype=bool)
    for i in range(probes):
        slot = ((ids.view(np.uint64) >> np.uint64(32 * i)) & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
        held &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
    return held


def _unit_rows(k, min_words, long_words, bitmap):
    """(id, kind, k1, k2, byte start and end, byte start of the line) of the units whose id may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            key = batch.column("k2").to_numpy()
            for c in TA.text_chunks(batch.column("text"), CHUNK_BYTES):
                u = _units(c, k, min_words, long_words, True, False)[0]
                at = np.flatnonzero(_may_hold(bitmap.value, u.ids, 2))
                text = u.text[at]
                base = c.offsets[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.ids[at]), pa.array(u.kind[at].astype(np.int32)), doc.slice(c.lo, c.n).take(pa.array(text)),
                     pa.array(key[c.lo:c.hi][text]), pa.array(u.start[at] - base), pa.array(u.end[at] - base),
                     pa.array(u.words.start[u.line[at]] - base)],
                    ["id", "kind", "doc_id", "k2", "pos", "end", "line"])
    return run


def _stretch_rows(texts, windows):
    """(id, doc_id, k2, byte start and end) of the stretches of PASSAGE words that hold a window whose id may be
    wanted, of texts whose key may be."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_may_hold(texts.value, batch.column("dk").to_numpy())))
            doc = batch.column("doc_id")
            key = batch.column("k2").to_numpy()
            for c in TA.text_chunks(batch.column("text"), CHUNK_BYTES):
                w = TA.words_of(c)
                h = TA.word_hashes(c, w)
                prefix = _prefix_hash(h)
                at = _anchors(h, w.text, w.first, w.count)
                at = at[_may_hold(windows.value, _stretch_hash(prefix, at, WINDOW))]
                top = w.first[w.text[at]]
                low = np.maximum(top, at + WINDOW - PASSAGE)
                high = np.minimum(at, top + w.count[w.text[at]] - PASSAGE)
                n = np.maximum(high - low + 1, 0)
                start = np.unique(np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n))
                text = w.text[start]
                base = c.offsets[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_stretch_hash(prefix, start, PASSAGE)), doc.slice(c.lo, c.n).take(pa.array(text)),
                     pa.array(key[c.lo:c.hi][text]), pa.array(w.start[start] - base),
                     pa.array(w.end[start + PASSAGE - 1] - base)], ["id", "doc_id", "k2", "pos", "end"])
    return run


def _gram_sets(k, min_words, long_words):
    """Gram sets of the wanted lines and pieces of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in TA.text_chunks(batch.column("text"), CHUNK_BYTES):
                u = _units(c, k, min_words, long_words, False, False)[0]
                text, (ids, grp, size) = _flat_lists(batch.column("want").slice(c.lo, c.n), ("id", "grp", "size"))
                key = TA.mix(ids.view(np.uint64) ^ TA.mix(text.astype(np.uint64)))
                order = np.argsort(key)
                text, ids, grp, size, key = text[order], ids[order], grp[order], size[order], key[order]
                # the first unit of each wanted text and id
                at = np.flatnonzero(np.isin(u.ids, ids))
                place = np.searchsorted(key, TA.mix(u.ids[at].view(np.uint64) ^ TA.mix(u.text[at].astype(np.uint64))))
                place = np.minimum(place, len(key) - 1)
                hit = (ids[place] == u.ids[at]) & (text[place] == u.text[at])
                place, first = np.unique(place[hit], return_index=True)
                grams, owner = u.grams(at[hit][first], k)
                order = np.lexsort((grams, owner))
                grams, owner = grams[order], owner[order]
                new = np.ones(len(grams), dtype=bool)
                new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
                n = np.bincount(owner[new], minlength=len(place))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[place]), pa.array(grp[place]), pa.array(size[place]),
                     pa.array(np.ones(len(place), np.int64)), TA.binary_array(grams[new], n)],
                    ["id", "grp", "size", "weight", "grams"])
    return run


def _flat_lists(lists: pa.ListArray, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of a column of lists of structs of longs: the row and the fields of every element (a null list has none)."""
    count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return np.repeat(np.arange(len(lists)), count), [pc.struct_field(flat, x).to_numpy(zero_copy_only=False) for x in names]


def _cut_texts(min_words):
    """Cut the removed spans out of each text; ``drop`` lists (pos, end) in bytes, overlaps are merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in TA.text_chunks(batch.column("text"), CHUNK_BYTES):
                w = TA.words_of(c)
                newline = c.data[:c.size] == 0x0A
                line = np.concatenate([[0], np.cumsum(newline)])[w.start] + w.text  # ascending
                first = np.flatnonzero(np.diff(line, prepend=-1))
                count = np.diff(first, append=len(line))
                n_units = np.bincount(w.text[first[count >= min_words]], minlength=c.n)
                text, (pos, end) = _flat_lists(batch.column("drop").slice(c.lo, c.n), ("pos", "end"))
                pos, end = pos + c.offsets[text], end + c.offsets[text]
                order = np.lexsort((end, pos))
                text, pos, end = text[order], pos[order], end[order]
                reach = np.maximum.accumulate(end) if len(end) else end
                new = np.ones(len(pos), dtype=bool)
                new[1:] = pos[1:] >= reach[:-1]
                head = np.flatnonzero(new)
                text, pos, end = text[head], pos[head], reach[np.append(head[1:], len(reach)) - 1] if len(head) else end
                # a span of whole lines goes with the newline after it
                lo, hi = c.offsets[text], c.offsets[text + 1]
                alone = (end < hi) & (c.data[end] == 0x0A) & ((pos == lo) | (c.data[np.maximum(pos - 1, 0)] == 0x0A))
                edge = np.bincount(pos, minlength=c.size + 1) - np.bincount(end + alone, minlength=c.size + 1)
                keep = np.cumsum(edge[:c.size]) == 0
                kept = c.data[:c.size][keep]
                size = np.concatenate([[0], np.cumsum(keep)])[c.offsets]
                n_spans = np.bincount(text, minlength=c.n)
                spans = pa.StructArray.from_arrays([pa.array(pos - lo), pa.array(end - lo)], ["start", "end"])
                part = batch.slice(c.lo, c.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_units.astype(np.int64)), part.column("n_shared"),
                     pa.array(n_spans.astype(np.int64)),
                     pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32), spans),
                     _strings(kept, size)],
                    ["doc_id", "n_paragraphs", "n_shared", "n_removed", "spans", "kept_text"])
    return run


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of UTF-8 bytes; bytes that are none become U+FFFD."""
    raw = data.tobytes()
    first = data[offsets[:-1][offsets[:-1] < offsets[1:]]]
    try:
        if (first & 0xC0 == 0x80).any():  # no text may begin inside a character
            raise UnicodeError
        raw.decode()
    except UnicodeError:
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))


def _has_repeated_rows(d: DataFrame) -> bool:
    return not d.groupBy("doc_id", "k2").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _repeats(spark: SparkSession, units: DataFrame, by: str, name: str) -> DataFrame:
    """Units of the classes ``by`` that stand at several places; all but the least (doc_id, k2, pos) are ``gone``."""
    units = saved(spark, units, f"{name}-units")
    there = F.struct("doc_id", "k2", "pos")
    least = saved(spark, units.groupBy(F.col(by).alias("class")).agg(F.min(there).alias("win"), F.max(there).alias("top"))
                  .where("win < top").select("class", "win"), f"{name}-winners")
    out = saved(spark, units.join(least, F.col(by) == F.col("class"))
                .select("doc_id", "k2", "pos", "end", "line", (there > F.col("win")).alias("gone")), f"{name}-repeats")
    discard(spark, units, least)
    return out


def _outside(units: DataFrame, repeats: DataFrame) -> DataFrame:
    """Units that overlap no removed span of their line."""
    r = repeats.where("gone").select(
        F.col("doc_id").alias("rdoc"), F.col("k2").alias("rk2"), F.col("line").alias("rline"),
        F.col("pos").alias("rpos"), F.col("end").alias("rend"))
    return units.join(r, F.col("doc_id").eqNullSafe(F.col("rdoc")) & (F.col("k2") == F.col("rk2"))
                      & (F.col("line") == F.col("rline")) & (F.col("pos") < F.col("rend"))
                      & (F.col("end") > F.col("rpos")), "left_anti")


def _untouched(spark: SparkSession, units: DataFrame, repeats: DataFrame, name: str) -> DataFrame:
    """Units that overlap no removed span of their text; both are met by stretches of ``NEAR`` bytes."""
    def buckets(start, stop):
        return F.explode(F.sequence(F.floor(F.col(start) / NEAR), F.floor((F.col(stop) - 1) / NEAR)))

    r = repeats.where("gone").select(F.col("doc_id").alias("rdoc"), F.col("k2").alias("rk2"), F.col("pos").alias("rpos"),
                                     F.col("end").alias("rend"), buckets("pos", "end").alias("rb"))
    hit = saved(spark, units.select("doc_id", "k2", "pos", "end", buckets("pos", "end").alias("b")).distinct().join(
        r, F.col("doc_id").eqNullSafe(F.col("rdoc")) & (F.col("k2") == F.col("rk2")) & (F.col("b") == F.col("rb"))
        & (F.col("pos") < F.col("rend")) & (F.col("end") > F.col("rpos")), "left_semi")
        .select(F.col("doc_id").alias("hdoc"), F.col("k2").alias("hk2"), F.col("pos").alias("hpos"),
                F.col("end").alias("hend")).distinct(), f"{name}-touched")
    return units.join(hit, F.col("doc_id").eqNullSafe(F.col("hdoc")) & (F.col("k2") == F.col("hk2"))
                      & (F.col("pos") == F.col("hpos")) & (F.col("end") == F.col("hend")), "left_anti")


def dedup_paragraphs(spark: SparkSession, docs: DataFrame, threshold: float = ND.THRESHOLD,
                     k: int = ND.SHINGLE_WORDS, target_recall: float = ND.TARGET_RECALL,
                     min_words: int = MIN_WORDS, long_words: int = LONG_WORDS) -> DataFrame:
    """One row per document: doc_id, n_paragraphs (lines of ``min_words`` words or more), n_shared (its lines, pieces
    and stretches that stand elsewhere too, those that stay included), n_removed (ranges cut), spans (removed byte
    ranges of the UTF-8 text) and kept_text."""
    bands, rows = ND.choose_bands(threshold, target_recall)
    d = docs.select("doc_id", F.xxhash64("text").alias("k2"), "text").where("text is not null")
    n_parts = ND.key_parts(spark)
    groups, often = ND.linked_groups(spark, d.select("text").mapInArrow(
        _keyed_rows(k, bands, rows, min_words, long_words, n_parts), ND.PACKED_KEYS))
    wanted = saved(spark, often.select("id").unionByName(groups.select("id")).distinct(), "wanted")
    discard(spark, often)
    repeated_rows = _has_repeated_rows(d)
    bitmap = spark.sparkContext.broadcast(_filter_bits(wanted, 2))
    units = d.mapInArrow(
        _unit_rows(k, min_words, long_words, bitmap),
        "id long, kind int, doc_id long, k2 long, pos long, end long, line long")
    if repeated_rows:  # rows equal in doc_id and text give the same units: all count as one document
        units = units.dropDuplicates(["doc_id", "k2", "pos", "end", "kind"])
    units = saved(spark, units, "units")
    coarse_units = units.where(F.col("kind") != WINDOWS)
    first = coarse_units.groupBy("id").agg(F.min(F.struct("doc_id", "k2")).alias("at"), F.count("*").alias("n"))
    first = saved(spark, first.join(groups, "id", "left").where("n > 1 or grp is not null"), "first")
    # gram sets of one copy of each candidate paragraph
    wants = first.where("grp is not null").groupBy("at.doc_id", "at.k2").agg(
        F.collect_list(F.struct("id", "grp", "size")).alias("want"))
    wants = wants.select(F.col("doc_id").alias("wdoc"), F.col("k2").alias("wk2"), "want")
    holders = d.join(wants, F.col("doc_id").eqNullSafe(F.col("wdoc")) & (F.col("k2") == F.col("wk2")))
    if repeated_rows:
        holders = holders.dropDuplicates(["wdoc", "wk2"])
    items = holders.select("text", "want").mapInArrow(
        _gram_sets(k, min_words, long_words), "id long, grp long, size long, weight long, grams binary")
    classes = ND.verified_classes(spark, items, threshold)
    member = saved(spark, first.join(classes.select("id", "comp"), "id", "left").where("n > 1 or comp is not null")
                   .select(F.col("id").alias("rid"), F.coalesce("comp", "id").alias("comp")), "members")
    discard(spark, first, groups, wanted)
    found = saved(spark, coarse_units.join(member, F.col("id") == F.col("rid")).drop("rid"), "found")
    # coarse to fine: what a removed line or piece holds does not stand for copies of it elsewhere
    lines = _repeats(spark, found.where(F.col("kind").bitwiseAND(LINE) > 0), "comp", "line")
    pieces = _repeats(spark, _outside(found.where(F.col("kind").bitwiseAND(PIECE) > 0), lines), "comp", "piece")
    coarse = lines.unionByName(pieces)
    free = saved(spark, _untouched(spark, units.where(F.col("kind") == WINDOWS), coarse, "window")
                 .select("id", F.xxhash64("doc_id", "k2").alias("dk")), "free-windows")
    discard(spark, units, found)
    again = saved(spark, free.groupBy(F.col("id").alias("aid")).agg(F.count("*").alias("n")).where("n > 1").select("aid"),
                  "again")
    windows = saved(spark, free.join(again, F.col("id") == F.col("aid")).select("id", "dk"), "windows")
    discard(spark, free, again)
    held_texts, held_windows = (spark.sparkContext.broadcast(_filter_bits(windows.select(F.col(c).alias("id")).distinct()))
                                for c in ("dk", "id"))
    # a stretch may reach into a removed span: its words stand at an earlier place all the same
    stretches = d.select("doc_id", "k2", F.xxhash64("doc_id", "k2").alias("dk"), "text").mapInArrow(
        _stretch_rows(held_texts, held_windows),
        "id long, doc_id long, k2 long, pos long, end long")
    passages = _repeats(spark, stretches.withColumn("line", F.lit(0).cast("long")), "id", "passage")
    per_text = coarse.unionByName(passages).groupBy(F.col("doc_id").alias("xdoc"), F.col("k2").alias("xk2")).agg(
        F.collect_set(F.struct("pos", "end", "gone")).alias("found"))  # a set: equal rows count as one document
    per_text = per_text.select("xdoc", "xk2", F.filter("found", lambda x: x["gone"]).alias("drop"), F.size("found").alias("shared"))
    out = d.join(per_text, F.col("doc_id").eqNullSafe(F.col("xdoc")) & (F.col("k2") == F.col("xk2")), "left") \
        .select("doc_id", "text", "drop", F.coalesce("shared", F.lit(0)).cast("long").alias("n_shared")).mapInArrow(
            _cut_texts(min_words),
            "doc_id long, n_paragraphs long, n_shared long, n_removed long, "
            "spans array<struct<start: long, end: long>>, kept_text string")
    none = F.lit(0).cast("long")
    empty = docs.where("text is null").select(
        "doc_id", none.alias("n_paragraphs"), none.alias("n_shared"), none.alias("n_removed"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
        F.lit(None).cast("string").alias("kept_text"))
    return out.unionByName(empty)
