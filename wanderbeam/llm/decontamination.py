"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.text import text_bytes

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = 8
# Within 23 bits at least one of eight 8-bit blocks differs in two bits or fewer.
RADIUS = 23
ITEMS_PER_PASS = 20_000
# Windows times items that are looked up at once: bounds the memory of a long text that repeats a template.
LOOKUP_CELLS = 1 << 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "doc_id long, item_id long, start_word int, window_words int, hamming int, similarity double"


@dataclass
class Shingles:
    """Hashes and weights of the shingles of a text; a shingle weighs as many as it has bytes."""

    words: int
    hashes: np.ndarray
    weights: np.ndarray


def normal_bytes(text: str | None) -> bytes:
    """The text in lower case (of all scripts) as UTF-8; NULL is empty."""
    return text_bytes((text or "").lower())


def shingles(raw: bytes, size: int) -> Shingles:
    """Shingles of ``size`` words; none if there are fewer words.

    Each word is hashed once; a shingle's hash mixes the hashes of its words in their order.
    """
    parts = raw.split()
    n = len(parts)
    if n < size:
        return Shingles(n, np.empty(0, np.uint64), np.empty(0, np.int64))
    word = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, n)
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)])
    m = n - size + 1
    mixed = word[:m].copy()
    for k in range(1, size):
        mixed = (mixed * _ODD) ^ (mixed >> np.uint64(29))
        mixed += word[k : k + m]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD
    return Shingles(n, mixed ^ (mixed >> np.uint64(29)), ends[size:] - ends[:m] - 1)


def bit_sums(s: Shingles) -> np.ndarray:
    """Running sums of +weight or -weight per bit, with a row of zeros first."""
    bits = np.unpackbits(s.hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    signed = (bits.astype(np.int64) * 2 - 1) * s.weights[:, None]
    return np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signed, axis=0)])


def fingerprints(sums: np.ndarray, start: np.ndarray, count: int) -> np.ndarray:
    """Weighted SimHash of the ``count`` shingles from each start."""
    bits = (sums[start + count] - sums[start]) > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


@dataclass
class Weighted:
    """A multiset of shingles: how often each stands in it, what one weighs, and the weight of all."""

    counts: dict[int, int]
    weight: dict[int, int]
    total: int


def weighted(hashes: np.ndarray, weights: np.ndarray) -> Weighted:
    found, n = np.unique(hashes, return_counts=True)
    return Weighted(dict(zip(found.tolist(), n.tolist())), dict(zip(hashes.tolist(), weights.tolist())), int(weights.sum()))


def weighted_similarity(a: Weighted, b: Weighted) -> float:
    """Weighted Jaccard similarity: the cost is that of the smaller multiset, whatever else is known."""
    both = sum(a.weight[h] * min(a.counts[h], b.counts[h]) for h in a.counts.keys() & b.counts.keys())
    whole = a.total + b.total - both
    return both / whole if whole else 0.0


@dataclass
class SizeIndex:
    """The items of one size: ids, fingerprints, shingle multisets and the blocks' neighbour tables."""

    size: int
    ids: np.ndarray
    prints: np.ndarray
    sets: list[Weighted]
    lightest: int  # smallest total weight of an item
    near: np.ndarray  # [block, value, item]: the item's block is within RADIUS // BLOCKS bits of the value


@dataclass
class Index:
    """Everything that documents are compared with; bounded by ITEMS_PER_PASS items."""

    sizes: list[SizeIndex]
    # Sorted hashes of all item shingles by shingle size, and a table of their low bits.
    known: dict[int, np.ndarray]
    table: dict[int, np.ndarray]
    # By shingle size: where the owners of each known hash start, and the owners as (number of the size, item in it).
    owners: dict[int, tuple[np.ndarray, np.ndarray]]


_TABLE_BITS = 20


def build_index(items: list[tuple[int, str | None]]) -> Index:
    """Items without words are left out; items of fewer than five words are one shingle."""
    by_size: dict[int, list[tuple[int, Shingles]]] = {}
    for item, text in items:
        raw = normal_bytes(text)
        n = len(raw.split())
        if n:
            by_size.setdefault(n, []).append((item, shingles(raw, min(SHINGLE, n))))
    values = np.arange(256, dtype=np.uint8)
    sizes, known = [], {}
    for n, entries in sorted(by_size.items()):
        k = min(SHINGLE, n)
        prints = np.array([int(fingerprints(bit_sums(s), np.array([0]), n - k + 1)[0]) for _, s in entries], np.uint64)
        blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        near = np.stack([np.bitwise_count(values[:, None] ^ blocks[None, :, b]) <= RADIUS // BLOCKS for b in range(BLOCKS)])
        sizes.append(SizeIndex(n, np.array([i for i, _ in entries], np.int64), prints, [weighted(s.hashes, s.weights) for _, s in entries], min(int(s.weights.sum()) for _, s in entries), near))
        for _, s in entries:
            known.setdefault(k, []).append(s.hashes)
    merged = {k: np.unique(np.concatenate(v)) for k, v in known.items()}
    owners = {k: _owners(k, hashes, sizes) for k, hashes in merged.items()}
    table = {}
    for k, hashes in merged.items():
        table[k] = np.zeros(1 << _TABLE_BITS, bool)
        table[k][(hashes & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True
    return Index(sizes, merged, table, owners)


def _owners(k: int, hashes: np.ndarray, sizes: list[SizeIndex]) -> tuple[np.ndarray, np.ndarray]:
    pairs = []
    for number, size in enumerate(sizes):
        if min(SHINGLE, size.size) == k:
            for item, held in enumerate(size.sets):
                at = np.searchsorted(hashes, np.fromiter(held.counts, np.uint64, len(held.counts)))
                pairs.append(np.column_stack([at, np.full(len(at), number), np.full(len(at), item)]))
    rows = np.concatenate(pairs)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    return np.searchsorted(rows[:, 0], np.arange(len(hashes) + 1)), rows[:, 1:]


def _known(hashes: np.ndarray, index: Index, k: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which shingles are an item's, and by number of the size the items that have one of them."""
    flags = index.table[k][(hashes & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)]
    at = np.flatnonzero(flags)
    if len(at):
        place = np.searchsorted(index.known[k], hashes[at])
        place[place == len(index.known[k])] = 0
        flags[at] = index.known[k][place] == hashes[at]
        place = np.unique(place[flags[at]])
    held: dict[int, np.ndarray] = {}
    if flags.any():
        starts, owners = index.owners[k]
        mine = np.concatenate([owners[starts[p] : starts[p + 1]] for p in place.tolist()])
        for number in np.unique(mine[:, 0]).tolist():
            held[number] = np.unique(mine[mine[:, 0] == number, 1])
    return flags, held


def _close(prints: np.ndarray, size: SizeIndex, items: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(window, item, distance) within RADIUS bits, window by window, from the block tables of ``items``."""
    blocks = prints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
    hit = np.zeros((len(prints), len(items)), bool)
    for b in range(BLOCKS):
        hit |= size.near[b][:, items][blocks[:, b]]
    window, found = np.nonzero(hit)
    item_at = items[found]
    distances = np.bitwise_count(prints[window] ^ size.prints[item_at]).astype(np.int64)
    close = distances <= RADIUS
    return zip(window[close].tolist(), item_at[close].tolist(), distances[close].tolist())


def matches(raw: bytes, index: Index) -> list[tuple[int, int, int, int, float]]:
    """(item, start word, words, Hamming distance, similarity) of the best window for each item found.

    Windows have the item's number of words, or all words of a shorter text. Benchmark shingles
    in a window bound its similarity to any item, so windows in which they weigh less than the wanted
    share of the window, or of the lightest item, can't match and get no fingerprint. The others are looked up in the block
    tables of the items that have a shingle in the text: every one within RADIUS bits has a block within two bits. What is found is
    checked by its true distance and then by exact weighted-shingle similarity. So the cost of a text does not
    grow with the items that it shares nothing with.
    """
    best: dict[int, tuple] = {}
    made: dict[int, tuple] = {}
    pieces: dict[int, Weighted] = {}
    shared: dict[int, np.ndarray] = {}
    for k in index.known:
        s = shingles(raw, k)
        flags, held = _known(s.hashes, index, k)
        if flags.any():
            shared |= held
            inside = np.concatenate([[0], np.cumsum(np.where(flags, s.weights, 0))])
            whole = np.concatenate([[0], np.cumsum(s.weights)])
            made[k] = (s, inside, whole, [])
    if not made:
        return []
    for number, size in enumerate(index.sizes):
        k = min(SHINGLE, size.size)
        # An item without a shingle in the text has no similarity to any window.
        if number not in shared:
            continue
        s, inside, whole, sums = made[k]
        if inside[-1] < SIMILARITY * size.lightest:
            continue
        count = min(size.size, s.words) - k + 1
        start = np.arange(len(s.hashes) - count + 1)
        known = inside[start + count] - inside[start]
        least = np.maximum(whole[start + count] - whole[start], size.lightest)
        start = start[known >= SIMILARITY * least]
        if not len(start):
            continue
        if not sums:
            sums.append(bit_sums(s))
        chunk = max(1, LOOKUP_CELLS // len(shared[number]))
        for at in range(0, len(start), chunk):
            some = start[at : at + chunk]
            for w, i, distance in _close(fingerprints(sums[0], some, count), size, shared[number]):
                a = int(some[w])
                if a not in pieces:
                    pieces.clear()
                    pieces[a] = weighted(s.hashes[a : a + count], s.weights[a : a + count])
                similarity = weighted_similarity(pieces[a], size.sets[i])
                if similarity >= SIMILARITY:
                    item = int(size.ids[i])
                    found = (-similarity, a, count + k - 1, distance)
                    best[item] = min(best.get(item, found), found)
        pieces.clear()
    return [(item, a, n, d, -s) for item, (s, a, n, d) in sorted(best.items())]


def passes(benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> Iterator[Index]:
    """Indexes over all items, each of a bounded number of them.

    Items are dealt to passes by a hash of their id; a pass that would be too large is not
    possible, because there are as many as the number of items asks for.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("item_id is not null")
    count = items.count()
    parts = max(1, -(-2 * count // items_per_pass)) if count > items_per_pass else 1
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part) if parts > 1 else items
        rows = mine.collect()
        if rows:
            yield build_index([tuple(r) for r in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """doc_id, item_id, start_word, window_words, hamming and similarity: the best window of each pair.

    Every document is held against every item, item block by item block; whole texts are read.
    NULL texts and items without words match nothing; rows without an item id are left out, rows without
    a doc_id and repeated rows are reported as they are. Empty tables give no rows.
    """
    out = docs.sparkSession.createDataFrame([], MATCHES)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    for index in passes(benchmark, items_per_pass):
        out = out.unionByName(rows.mapInPandas(_finder(index), MATCHES))
    return out


def _finder(index: Index):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (None if doc is None else int(doc), *m)
                for doc, text in zip(batch["doc_id"], batch["text"])
                for m in matches(normal_bytes(text), index)
            ]
            frame = pd.DataFrame(found, columns=["doc_id", "item_id", "start_word", "window_words", "hamming", "similarity"])
            yield frame.astype({"doc_id": "Int64"})

    return find


def _holder(index: Index):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(matches(normal_bytes(t), index)) for t in texts], dtype=bool)

    return holds


def clean(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """The documents that hold no benchmark item, with the columns of ``docs`` and no shuffle."""
    for index in passes(benchmark, items_per_pass):
        docs = docs.where(~_holder(index)(F.col("text")))
    return docs
