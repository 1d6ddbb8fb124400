"""Benchmark decontamination under edit distance.

Words are the alphabet. The CGK embedding walks a window of words with a random walk, so
that two windows at a small edit distance get strings at a small Hamming distance; sampled
positions of the string are LSH keys. How many walks are repeated is found for each window
size by embedding edited windows until the target recall is reached. Each item gives
item-sized windows at its head and tail; document windows of the same sizes that hold too few
benchmark words for any item are passed over (no loss: edits bound the number of foreign
words), the rest are embedded, and each window that shares a key with an item is verified by
exact edit distance on the words around it.

The benchmark is taken in blocks of bounded bytes; each block is shipped to all tasks and
documents are scanned where they lie. Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litfunnel.llm.common import short_batches, slices, staged, texts_of
from litfunnel.llm.words import coded_words

#: Edits allowed, as a share of the item's words. Items of fewer words allow none and are looked up as they are.
EDITS = 0.2
LEAST_WORDS = 5
#: Share of edited items that must share a key, of those with as many edits as allowed.
RECALL = 0.99
SAMPLINGS, SAMPLED = 4, 3
LEAST_WALKS, TRIALS = 8, 60
#: Where twice as many walks still miss the recall, edits are too many for keys: only the exact way is left.
HOPELESS_WALKS = 2048
BLOCK_BYTES = 16 << 20
#: Words of one piece of a longer item. Of an item within the edits some piece is, too; pieces nominate
#: places, the whole item is verified there.
ITEM_WORDS = 64
_GRID_RATIO = 1.2
#: Shares of an item window's words, rarest first, by which windows are passed over.
RARE_SHARES = (0.6, 1.0, 0.35)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def size_grid(top: int) -> list[int]:
    sizes = [LEAST_WORDS]
    while sizes[-1] < top:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * _GRID_RATIO)))
    return sizes


def embedded_keys(ids: np.ndarray, starts: np.ndarray, size: int, walks: int) -> np.ndarray:
    """LSH keys, one row per start and one column per repetition, of the windows ids[start : start + size].

    Step j of a walk shows the word under the pointer, which then moves on by a random bit of
    (walk, j, word). Past its end a window shows 0. The first walks are the same however many follow.
    """
    rng = np.random.default_rng(size)
    steps = 2 * size
    keys = np.empty((len(starts), walks * SAMPLINGS), np.uint64)
    for walk in range(walks):
        sampled = [rng.choice(steps, SAMPLED, replace=False) for _ in range(SAMPLINGS)]
        bits = rng.integers(1, 1 << 62, steps).astype(np.uint64) | np.uint64(1)
        pointer = np.zeros(len(starts), np.int64)
        own = [np.full(len(starts), walk * SAMPLINGS + s + 1, np.uint64) for s in range(SAMPLINGS)]
        for j in range(1 + max(int(x.max()) for x in sampled)):
            word = np.where(pointer < size, ids[starts + np.minimum(pointer, size - 1)], 0).astype(np.uint64)
            for s in range(SAMPLINGS):
                if j in sampled[s]:
                    x = (own[s] ^ word) * _C1
                    own[s] = x ^ (x >> np.uint64(29))
            pointer += (((word + np.uint64(1)) * bits[j] * _C2) >> np.uint64(47) & np.uint64(1)).astype(np.int64)
        for s in range(SAMPLINGS):
            keys[:, walk * SAMPLINGS + s] = own[s]
    return keys


def edited(words: np.ndarray, n: int, kind: int, rng: np.random.Generator) -> np.ndarray:
    """words after n edits at random places: 0 substitutions, 1 deletions, 2 insertions, 3 any of them."""
    out = words.tolist()
    for _ in range(n):
        at, foreign = int(rng.integers(len(out))), int(rng.integers(1 << 40, 1 << 41))
        what = kind if kind < 3 else int(rng.integers(3))
        out[at : at + (what < 2)] = [] if what == 1 and len(out) > 1 else [foreign]
    return np.array(out)


@lru_cache
def walks_for(size: int, edits: float, recall: float) -> int:
    """Walks that reach the recall for windows of this size with as many edits as allowed, whatever
    their kind, found on TRIALS edited items of each kind. Edits that no number of walks up to
    HOPELESS_WALKS covers are an error: exact=True finds them without keys."""
    rng = np.random.default_rng(7 * size + 1)
    length = max(size, min(int(size * _GRID_RATIO), ITEM_WORDS))
    words = rng.integers(1, 1 << 30, (4 * TRIALS, length))
    texts, item_at, text_at, trial = [], [], [], []
    for t in range(4 * TRIALS):
        changed = edited(words[t], int(edits * length), t % 4, rng)
        base = sum(map(len, texts))
        texts.append(np.r_[changed, rng.integers(1 << 41, 1 << 42, size + 4)])
        # The windows that begin where the item's head and tail window do, and their neighbours.
        tail = max(0, len(changed) - size)
        for start, places in ((0, range(3)), (length - size, range(max(0, tail - 2), tail + 3))):
            text_at += [base + a for a in places]
            item_at += [t * length + start] * len(places)
            trial += [t] * len(places)
    ids, item_at, text_at = np.concatenate(texts), np.array(item_at), np.array(text_at)
    walks = LEAST_WALKS
    while True:
        walks *= 2
        same = embedded_keys(words.ravel(), item_at, size, walks) == embedded_keys(ids, text_at, size, walks)
        found = np.zeros((4 * TRIALS, walks), bool)
        np.logical_or.at(found, np.array(trial), same.reshape(len(trial), walks, SAMPLINGS).any(2))
        by_kind = np.logical_or.accumulate(found, axis=1).reshape(TRIALS, 4, walks).mean(0).min(0)
        enough = np.flatnonzero(by_kind >= recall)
        if len(enough):
            return max(LEAST_WALKS, int(enough[0]) + 1)
        if walks >= HOPELESS_WALKS:
            raise ValueError(f"a recall of {recall} is out of reach for {edits} edits a word in windows of {size} words; use exact=True")


def closest_stretch(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of words nearest to item by edit distance, the first such."""
    n = len(words)
    row, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    at = np.arange(n + 1)
    for x in item:
        change = row[:-1] + (words != x)
        drop = row + 1
        best = drop.copy()
        from_change = change < drop[1:]
        best[1:] = np.where(from_change, change, drop[1:])
        start = begin.copy()
        start[1:] = np.where(from_change, begin[:-1], begin[1:])
        # Words of the document that the item lacks: carry the least of (cost - place) rightwards.
        lead = best - at
        least = np.minimum.accumulate(lead)
        holder = np.maximum.accumulate(np.where(lead == least, at, 0))
        row, begin = least + at, start[holder]
    end = int(np.argmin(row))
    return int(row[end]), int(begin[end]), end


@dataclass
class Block:
    """A bounded part of the benchmark, ready for the scan."""

    vocabulary: dict[str, int]
    items: list[tuple[int, np.ndarray]]  # number of the text, word ids of the whole item
    pieces: list[tuple[int, int]]  # item, first word of the piece
    #: By window size: walks, the filters (which words count, how many are needed), sorted keys, and for each key piece and offset.
    sizes: dict[int, tuple[int, list[tuple[np.ndarray, int]], np.ndarray, np.ndarray, np.ndarray]]
    #: By number of words below LEAST_WORDS: the items' words.
    short: dict[int, list[int]]


def block_of(texts: list[str], edits: float = EDITS, recall: float = RECALL, exact: bool = False) -> Block:
    """Items are numbered by their place in texts; those without words aren't items. The exact way needs
    no walks, but one for the offsets of its windows."""
    distinct, codes, bounds = coded_words(texts)
    items, pieces, piece_words, short = [], [], [], {}
    for number, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        words = codes[a:b] + 1
        if not len(words):
            continue
        items.append((number, words))
        if len(words) < LEAST_WORDS:
            short.setdefault(len(words), []).append(len(items) - 1)
            continue
        first = 0
        for piece in np.array_split(words, max(1, -(-len(words) // ITEM_WORDS))):
            pieces.append((len(items) - 1, first))
            piece_words.append(piece)
            first += len(piece)
    grid = size_grid(ITEM_WORDS)
    by_size: dict[int, list[int]] = {}
    for k, words in enumerate(piece_words):
        by_size.setdefault(max(g for g in grid if g <= len(words)), []).append(k)
    sizes = {}
    # Rare words first: in few items, and long.
    held_by = np.bincount(np.concatenate([np.unique(w) for _, w in items]) if items else [], minlength=len(distinct) + 1)
    rarity = np.empty(len(distinct) + 1, np.int64)
    rarity[np.lexsort((-np.array([99, *map(len, distinct)]), held_by))] = np.arange(len(distinct) + 1)
    for size, own in by_size.items():
        walks = 1 if exact else walks_for(size, edits, recall)
        keys, number, offset = [], [], []
        filters = []
        for share in RARE_SHARES:
            q, counts, least = max(1, int(share * size)), np.zeros(len(distinct) + 1, bool), size
            for k in own:
                words = piece_words[k]
                for start in np.unique([0, len(words) - size]):
                    window = words[start : start + size]
                    # Ties in rarity take in every place of a word, so that a count bounds the edits.
                    kept = np.sort(rarity[window])[q - 1]
                    chosen = window[rarity[window] <= kept]
                    counts[chosen] = True
                    least = min(least, len(chosen) - int(edits * len(words)))
            filters.append((counts, least))
        for k in own:
            words = piece_words[k]
            starts = np.unique([0, len(words) - size])
            got = embedded_keys(words, starts, size, walks)
            keys.append(got.ravel())
            number.append(np.full(got.size, k))
            offset.append(np.repeat(starts, got.shape[1]))
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        sizes[size] = (walks, filters, flat[order], np.concatenate(number)[order], np.concatenate(offset)[order])
    return Block({w: i + 1 for i, w in enumerate(distinct)}, items, pieces, sizes, short)


def open_windows(ids: np.ndarray, owner_end: np.ndarray, size: int, filters: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Starts of the windows that hold enough of the benchmark's words."""
    starts = None
    for counts, least in filters:
        if least <= 0:
            continue
        held = np.zeros(len(ids) + size + 1, np.int32)
        np.cumsum(counts[ids], out=held[1 : len(ids) + 1])
        held[len(ids) + 1 :] = held[len(ids)]
        if starts is None:
            starts = np.flatnonzero(held[size:-1] - held[: len(ids)] >= least)
        else:
            starts = starts[held[np.minimum(starts + size, owner_end[starts])] - held[starts] >= least]
    return np.arange(len(ids)) if starts is None else starts


def nominated(ids: np.ndarray, bounds: np.ndarray, block: Block, exact: bool) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Places to verify: (text, item, slot) with the first and the last place where the item may begin."""
    owner_end = np.repeat(bounds[1:], np.diff(bounds))
    found: dict[tuple[int, int, int], tuple[int, int]] = {}

    def note(text: np.ndarray, piece: np.ndarray, place: np.ndarray) -> None:
        for t, k, p in set(zip(text.tolist(), piece.tolist(), place.tolist(), strict=True)):
            item, first = block.pieces[k]
            slot = (t, item, (p - first) // max(1, len(block.items[item][1]) // 2))
            a, b = found.get(slot, (p - first, p - first))
            found[slot] = (min(a, p - first), max(b, p - first))

    for size, (walks, filters, keys, number, offset) in block.sizes.items():
        starts = open_windows(ids, owner_end, size, filters)
        if not len(starts):
            continue
        text_of = lambda at: np.searchsorted(bounds, at, "right") - 1
        if exact:
            for k in np.unique(number):
                for o in np.unique(offset[number == k]):
                    note(text_of(starts), np.full(len(starts), k), starts - o)
            continue
        # A window at the end of its text is filled up with 0, a word of no item.
        padded = np.r_[ids, np.zeros(size, np.int64)]
        short = starts[starts + size > owner_end[starts]]
        whole = starts[starts + size <= owner_end[starts]]
        got, at = [embedded_keys(padded, whole, size, walks)], [whole]
        if len(short):
            tail = np.zeros((len(short), size), np.int64)
            for i, s in enumerate(short):
                tail[i, : owner_end[s] - s] = ids[s : owner_end[s]]
            got.append(embedded_keys(tail.ravel(), np.arange(len(short)) * size, size, walks))
            at.append(short)
        flat, where = np.concatenate(got), np.concatenate(at)
        low, high = np.searchsorted(keys, flat.ravel(), "left"), np.searchsorted(keys, flat.ravel(), "right")
        hit = np.flatnonzero(high > low)
        count = high[hit] - low[hit]
        entry = np.repeat(low[hit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        start = np.repeat(where[hit // flat.shape[1]], count)
        note(text_of(start), number[entry], start - offset[entry])
    return found


def short_matches(ids: np.ndarray, bounds: np.ndarray, block: Block) -> list[tuple[int, int, int, int, int]]:
    """Items of fewer than LEAST_WORDS words where they stand word for word."""
    out = []
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for size, items in block.short.items():
        n = len(ids) - size + 1
        if n <= 0:
            continue
        windows = np.lib.stride_tricks.sliding_window_view(ids, size)
        inside = text[:n] == text[size - 1 :]
        for item in items:
            at = np.flatnonzero(inside & (windows == block.items[item][1]).all(1))
            out += [(t, item, 0, int(a - bounds[t]), int(a + size - bounds[t])) for t, a in zip(text[at].tolist(), at.tolist(), strict=True)]
    return out


def matches(texts: list[str], block: Block, edits: float = EDITS, exact: bool = False) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, edits, first word, end word) of every stretch found.

    exact verifies every open window instead of those that share a key.
    """
    distinct, codes, bounds = coded_words(texts)
    lookup = np.fromiter((block.vocabulary.get(w, 0) for w in distinct), np.int64, len(distinct))
    if not len(codes):
        return []
    ids = lookup[codes]
    out = short_matches(ids, bounds, block)
    for (t, k, _), (a, b) in nominated(ids, bounds, block, exact).items():
        item = block.items[k][1]
        allowed = int(edits * len(item))
        lo, hi = max(bounds[t], a - allowed - 1), min(bounds[t + 1], b + len(item) + allowed + 1)
        # Words of no item stand for edits whatever they are.
        n, start, end = closest_stretch(item, ids[lo:hi])
        if n <= allowed:
            out.append((t, k, n, int(lo + start - bounds[t]), int(lo + end - bounds[t])))
    return out


def blocks_of(benchmark: DataFrame, edits: float, recall: float, block_bytes: int, exact: bool) -> tuple[DataFrame, list[tuple[list[str], Block]]]:
    """The benchmark's (item_id, text_key), staged, and its distinct texts in blocks of about block_bytes.

    Texts that many items share are taken once. The driver reads one block after another; what it
    holds and ships is the benchmark itself, a fixed input that doesn't grow with the documents.
    """
    own = staged(benchmark.where("text IS NOT NULL").select("item_id", F.md5("text").alias("text_key"), "text"), "benchmark")
    texts = own.groupBy("text_key").agg(F.first("text").alias("text"))
    volume, distinct = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    n = max(1, min(distinct, -(-volume // block_bytes)))
    out = []
    for k in range(n):
        rows = list((texts if n == 1 else texts.where(F.pmod(F.xxhash64("text_key"), F.lit(n)) == k)).toLocalIterator())
        out.append(([r.text_key for r in rows], block_of([r.text for r in rows], edits, recall, exact)))
    return own.select("item_id", "text_key"), out


def contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL, exact: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, edits, item_words, first_word, end_word.

    docs needs doc_id and text, benchmark item_id and text; other columns are ignored. An item
    is found where some stretch of the document's words is within floor(edits * words of the
    item) word edits of it; the nearest, then first, stretch is shown. Items of fewer than
    LEAST_WORDS words allow no edit and are found word for word; items without words, null and
    empty texts find nothing. Items of more than ITEM_WORDS words are nominated by their pieces
    and verified whole. Repeated documents and repeated items are all reported, an item_id once
    for each of its texts. recall is the share of items with as many edits as allowed that a
    window must lead to; with exact every window that could hold an item is verified.
    """
    named, blocks = blocks_of(benchmark, edits, recall, block_bytes, exact)
    found = reduce(DataFrame.unionByName, [scanned(docs, keys, block, edits, exact) for keys, block in blocks])
    # As many rows as the benchmark has items: broadcast only if Spark finds them few.
    return found.join(named, "text_key").select("doc_id", "item_id", "edits", "item_words", "first_word", "end_word")


def scanned(docs: DataFrame, keys: list[str], block: Block, edits: float, exact: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((keys, block))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            keys, block = shared.value
            doc_ids = batch.column("doc_id")
            best: dict[tuple[int, int], tuple] = {}
            for t, k, n, a, b in matches(texts_of(batch.column("text")), block, edits, exact):
                row = (n, a, b, len(block.items[k][1]))
                if (t, k) not in best or row < best[t, k]:
                    best[t, k] = row
            got = sorted(best.items())
            yield pa.record_batch(
                [doc_ids.take(pa.array([t for (t, _), _ in got], pa.int64())), pa.array([keys[block.items[k][0]] for (_, k), _ in got], pa.string()), *(pa.array([r[i] for _, r in got], pa.int64()) for i in (0, 3, 1, 2))],
                names=["doc_id", "text_key", "edits", "item_words", "first_word", "end_word"],
            )

    return short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, text_key string, edits long, item_words long, first_word long, end_word long")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL, exact: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs in which no item is found, with all their columns; cases as in contaminated."""
    _, blocks = blocks_of(benchmark, edits, recall, block_bytes, exact)
    kept = short_batches(docs)
    for _, block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 4 << 20):
                hit = {x[0] for x in matches(texts_of(batch.column("text")), shared.value, edits, exact)}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
