"""Which keys of a document occur in other documents: an exchange of packed key blocks.

A task gathers the keys of many documents, settles among them what it can, and sends the rest
as one packed block per bucket of the key space. A bucket sees each key at most once per block and
document, so a passage that a third of all documents share costs one entry per block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BLOCK_KEYS = 1_000_000
PACKED = "bucket int, settled boolean, body binary"
ANSWERS = "bucket int, body binary"
FOUND = "doc_id long, variant long, places binary"


@dataclass
class Keys:
    """Parallel arrays: key (hi, lo), document (id, variant) and place of every occurrence."""

    hi: np.ndarray
    lo: np.ndarray
    doc: np.ndarray
    variant: np.ndarray
    place: np.ndarray

    def take(self, at: np.ndarray) -> Keys:
        return Keys(self.hi[at], self.lo[at], self.doc[at], self.variant[at], self.place[at])

    @staticmethod
    def joined(parts: list[Keys]) -> Keys:
        return Keys(*[np.concatenate([getattr(p, n) for p in parts]) for n in ("hi", "lo", "doc", "variant", "place")])

    def sorted(self) -> Keys:
        order = np.argsort(self.hi, kind="stable")
        out = self.take(order)
        # Equal hi with different lo is a rare clash; only then the second key is sorted too.
        same = out.hi[1:] == out.hi[:-1]
        return self.take(np.lexsort((self.lo, self.hi))) if (same & (out.lo[1:] != out.lo[:-1])).any() else out


def runs(keys: Keys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted keys: start of each run, and per entry the smallest and largest document of its run."""
    fresh = np.ones(len(keys.hi), bool)
    fresh[1:] = (keys.hi[1:] != keys.hi[:-1]) | (keys.lo[1:] != keys.lo[:-1])
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(fresh)))
    low = np.repeat(np.minimum.reduceat(keys.doc, starts), sizes)
    high = np.repeat(np.maximum.reduceat(keys.doc, starts), sizes)
    return starts, low, high


def _runs_of_docs(keys: Keys) -> tuple[np.ndarray, np.ndarray]:
    change = np.ones(len(keys.doc), bool)
    change[1:] = (keys.doc[1:] != keys.doc[:-1]) | (keys.variant[1:] != keys.variant[:-1])
    starts = np.flatnonzero(change)
    return starts, np.diff(np.append(starts, len(change))).astype("<i4")


def pack(keys: Keys, wide: bool | None) -> bytes:
    """Entries in document order as bytes; ``wide`` keeps 96 bits of the key, else 32, None keeps no key."""
    starts, counts = _runs_of_docs(keys)
    head = np.array([len(starts), len(keys.hi)], "<i8").tobytes()
    parts = [head, keys.doc[starts].tobytes(), keys.variant[starts].tobytes(), counts.tobytes(), keys.place.astype("<i4").tobytes()]
    if wide:
        parts += [keys.hi.tobytes(), keys.lo.astype("<u4").tobytes()]
    elif wide is not None:
        parts.append(keys.hi.astype("<u4").tobytes())
    return b"".join(parts)


def unpack(body: bytes, wide: bool | None) -> Keys:
    docs, n = np.frombuffer(body, "<i8", 2).tolist()
    at = 16

    def read(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    ids, variants, counts = read("<i8", docs), read("<i8", docs), read("<i4", docs)
    place = read("<i4", n)
    if wide is None:
        hi = np.zeros(n, np.uint64)
    else:
        hi = read("<u8", n) if wide else read("<u4", n).astype(np.uint64)
    lo = read("<u4", n).astype(np.uint64) if wide else np.zeros(n, np.uint64)
    return Keys(hi, lo, np.repeat(ids, counts), np.repeat(variants, counts), place)


def places(keys: Keys) -> pd.DataFrame:
    """One row per document of ``keys``, which are in document order."""
    starts, counts = _runs_of_docs(keys)
    ends = starts + counts
    body = keys.place.astype("<i4")
    return pd.DataFrame(
        {
            "doc_id": keys.doc[starts],
            "variant": keys.variant[starts],
            "places": [body[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())],
        }
    )


def by_document(keys: Keys, buckets: int) -> list[tuple[int, bytes]]:
    """Entries in document order as one packed answer for each bucket of documents."""
    mixed = (keys.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ keys.variant.astype(np.uint64)
    bucket = ((mixed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, bucket = keys.take(order), bucket[order]
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(bucket)]
    return [(int(bucket[a]), pack(keys.take(np.arange(a, b)), None)) for a, b in zip(edge, edge[1:])]


@dataclass
class Gatherer:
    """Collects the keys of documents and turns them into packed rows.

    ``later``: find occurrences with an equal key in a document with a smaller id; otherwise
    find those with an equal key in any other document.
    """

    buckets: int
    wide: bool
    later: bool
    parts: list[Keys] = field(default_factory=list)
    size: int = 0

    def add(self, doc: int, variant: int, hi: np.ndarray, lo: np.ndarray, place: np.ndarray) -> None:
        n = len(hi)
        if n:
            self.parts.append(Keys(hi, lo, np.full(n, doc, np.int64), np.full(n, variant, np.int64), place))
            self.size += n

    def rows(self) -> Iterator[pd.DataFrame]:
        if not self.parts:
            return
        keys = Keys.joined(self.parts).sorted()
        self.parts, self.size = [], 0
        starts, low, high = runs(keys)
        if self.later:
            settled = keys.doc > low
            sent = ~settled
        else:
            settled = low < high
            sent = ~settled
            # An entry of the smallest and one of the largest document tell other blocks of the key, so that a block
            # with one of the two ids meets the other; place -1: no answer wanted.
            run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(settled))))
            for edge in (low, high):
                at = np.flatnonzero(settled & (keys.doc == edge))
                sent[at[np.unique(run[at], return_index=True)[1]]] = True
        out = self._block(keys, sent, (not self.later) & settled)
        found = keys.take(np.flatnonzero(settled))
        if len(found.hi):
            order = np.lexsort((found.place, found.variant, found.doc))
            body = found.take(order)
            out += [(bucket, True, part) for bucket, part in by_document(body, self.buckets)]
        yield pd.DataFrame(out, columns=["bucket", "settled", "body"])

    def _block(self, keys: Keys, sent: np.ndarray, mute: np.ndarray) -> list[tuple]:
        at = np.flatnonzero(sent)
        place = np.where(mute[at], -1, keys.place[at])
        part = keys.take(at)
        part.place = place
        bucket = (part.hi % np.uint64(self.buckets)).astype(np.int64)
        if not self.wide:
            part.hi = part.hi // np.uint64(self.buckets) & np.uint64(0xFFFFFFFF)
        # By bucket, then in document order, so that documents pack into runs.
        order = np.lexsort((place, part.variant, part.doc, bucket))
        part, bucket = part.take(order), bucket[order]
        edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist() + [len(bucket)]
        return [(int(bucket[a]), False, pack(part.take(np.arange(a, b)), self.wide)) for a, b in zip(edge, edge[1:])]


def found_elsewhere(
    docs: DataFrame, keys_of: Callable[[pd.DataFrame], Iterator[tuple]], buckets: int, wide: bool, later: bool
) -> DataFrame:
    """doc_id, variant and the places (int32 bytes) whose keys other documents hold too, a row per document.

    ``keys_of`` turns a batch of ``docs`` into (doc_id, variant, hi, lo, place) per document. Blocks
    meet by bucket of keys, answers by bucket of documents. With ``wide`` false a key is known by 32 bits plus its bucket, so a few
    places may be found without a match: use it to look for candidates only.
    """

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Gatherer(buckets, wide, later)
        for batch in batches:
            for item in keys_of(batch):
                block.add(*item)
                if block.size >= BLOCK_KEYS:
                    yield from block.rows()
        yield from block.rows()

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(int(b), part) for b, part in zip(rows["bucket"], rows["body"])] if rows["settled"].all() else []
        if not out:
            out = [(int(rows["bucket"].iloc[0]), b) for b in rows.loc[rows["settled"], "body"]]
            keys = Keys.joined([unpack(b, wide) for b in rows.loc[~rows["settled"], "body"]]).sorted()
            _, low, high = runs(keys)
            hit = keys.doc > low if later else (low < high) & (keys.place >= 0)
            found = keys.take(np.flatnonzero(hit))
            if len(found.hi):
                out += by_document(found.take(np.lexsort((found.place, found.variant, found.doc))), buckets)
        return pd.DataFrame(out, columns=["bucket", "body"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        found = Keys.joined([unpack(b, None) for b in rows["body"]])
        return places(found.take(np.lexsort((found.place, found.variant, found.doc))))

    answers = docs.mapInPandas(gather, PACKED).groupBy("bucket").applyInPandas(settle, ANSWERS)
    return answers.groupBy("bucket").applyInPandas(answer, FOUND)


def bucket_count(text_bytes: int, least: int, bucket_bytes: int = 16 << 20) -> int:
    """Buckets so that each answers for about ``bucket_bytes`` of text, whatever its size."""
    return max(least, -(-text_bytes // bucket_bytes), 1)

