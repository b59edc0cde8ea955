"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

For a benchmark item of m shingles (five words; a shorter item is one shingle)
every window of m shingles of a document is a candidate passage.  Windows that
hold none of the items' shingles cannot reach any similarity above 0 and are
passed over.  The others get a 64-bit SimHash, weighted by how often a shingle
occurs in the window.  Fingerprints are cut into ``BLOCKS`` blocks; two within
``radius`` agree in some block up to radius // BLOCKS bits, so looking every block
up in a table of the items' blocks finds all items within the radius.  These are
verified by the exact weighted similarity of the shingle bags,
sum of minima / sum of maxima >= ``threshold``.  A document with fewer shingles
than an item is one window.

The benchmark's size is measured first; it is worked off in blocks of items of at
most about ``block_bytes`` of text, each broadcast to a pass over the documents.
Documents are never shuffled, and no step depends on how many hold a passage.

Defined cases: null or empty texts and items match nothing; repeated items and
documents give a pair each; empty tables give no pairs; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SHINGLE, chunks, mix64, shingles

BLOCKS = 8
RADIUS = 21
THRESHOLD = 0.8
SCHEMA = "doc_id {}, item_id {}, similarity double, first_word long, n_words long"
_SIGN: list[np.ndarray] = []
_NEAR: dict[int, np.ndarray] = {}


def _signs(h: np.ndarray) -> np.ndarray:
    """Rows of 64 signs (int32), one row for each shingle."""
    bits = np.unpackbits(mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).view(np.uint8).reshape(len(h), 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as rows of 8 bytes from rows of 64 signed sums."""
    return np.packbits(sums > 0, axis=1)


def _near(radius: int) -> np.ndarray:
    """256 x 256: whether two block values differ in at most ``radius`` bits."""
    if radius not in _NEAR:
        v = np.arange(256, dtype=np.uint8)
        _NEAR[radius] = np.unpackbits((v[:, None] ^ v[None, :])[..., None], axis=2).sum(axis=2) <= radius
    return _NEAR[radius]


class ItemIndex:
    """Shingle vocabulary, fingerprints and Hamming block tables of one block of items."""

    def __init__(self, ids: list, texts: list[str | None], radius: int = RADIUS):
        per = []
        for _, _, buf, off in chunks(pa.array([t or "" for t in texts], pa.string())):
            h, o, _ = shingles(buf, off)
            per += [h[o[i]:o[i + 1]] for i in range(len(off) - 1)]
        keep = [i for i, h in enumerate(per) if len(h)]
        self.ids, self.bags, self.radius = [ids[i] for i in keep], [per[i] for i in keep], radius
        self.m = np.array([len(h) for h in self.bags], dtype=np.int64)
        self.vocab = np.unique(np.concatenate(self.bags)) if keep else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 20, dtype=bool)                      # by the low 20 bits
        self.filter[(self.vocab & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.counts = []                                                 # sorted vocabulary places and counts
        for h in self.bags:
            self.counts.append(np.unique(np.searchsorted(self.vocab, h), return_counts=True))
        if keep:
            self.prints = simhash(np.stack([_signs(h).sum(axis=0) for h in self.bags]))
            # tables[b][v]: the items whose block b lies within radius // BLOCKS bits of v
            self.tables = [_near(radius // BLOCKS)[:, self.prints[:, b]] for b in range(BLOCKS)]

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary place of every shingle, -1 where no item has it."""
        out = np.full(len(h), -1, dtype=np.int64)
        may = np.flatnonzero(self.filter[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(may):
            i = np.minimum(np.searchsorted(self.vocab, h[may]), len(self.vocab) - 1)
            ok = self.vocab[i] == h[may]
            out[may[ok]] = i[ok]
        return out

    def match(self, h: np.ndarray, place: np.ndarray, threshold: float):
        """(item, similarity, first shingle, shingles) of the best window of each item found in one document."""
        hit = np.flatnonzero(place >= 0)
        best: dict[int, tuple[float, int, int]] = {}
        # stretches of the document around hits, so that far-apart passages stay apart
        reach = int(self.m.max())
        cut = np.flatnonzero(np.diff(hit) > 2 * reach) + 1
        for part in np.split(hit, cut):
            a, b = max(0, int(part[0]) - reach), min(len(h), int(part[-1]) + reach + 1)
            sums = np.zeros((b - a + 1, 64), dtype=np.int32)
            np.cumsum(_signs(h[a:b]), axis=0, out=sums[1:])
            found = np.concatenate([[0], np.cumsum(place[a:b] >= 0)])
            for m in np.unique(self.m):
                items = np.flatnonzero(self.m == m)
                width = int(min(m, len(h)))
                start = np.arange(b - a - width + 1)
                start = start[found[start + width] > found[start]]
                for s in range(0, len(start), 2048):                     # bounded memory for long stretches
                    at = start[s:s + 2048]
                    prints = simhash(sums[at + width] - sums[at])
                    for w, i in zip(*self._within(prints, items)):
                        self._verify(place, a + int(at[w]), width, int(items[i]), threshold, best)
        return [(i, *best[i]) for i in sorted(best)]

    def _within(self, prints: np.ndarray, items: np.ndarray):
        """Pairs (window, item) within the radius, through the block tables."""
        near = np.zeros((len(prints), len(items)), dtype=bool)
        for b in range(BLOCKS):
            near |= self.tables[b][:, items][prints[:, b]]
        w, i = np.nonzero(near)
        far = np.unpackbits(prints[w] ^ self.prints[items[i]], axis=1).sum(axis=1)
        return w[far <= self.radius], i[far <= self.radius]

    def _verify(self, place, start, width, item, threshold, best):
        p, c = self.counts[item]
        u, n = np.unique(place[start:start + width], return_counts=True)
        at = np.minimum(np.searchsorted(p, u), len(p) - 1)
        both = int(np.minimum(c[at], n)[p[at] == u].sum())
        score = both / (width + int(self.m[item]) - both)
        if score >= threshold and (item not in best or (score, -start) > (best[item][0], -best[item][1])):
            best[item] = (score, start, width)


def _best(x: ItemIndex, col: pa.Array, threshold: float):
    """(row, item, similarity, first shingle, shingles) of everything found in a column of texts."""
    if not x.ids:
        return
    for i0, _, buf, off in chunks(col):
        h, o, _ = shingles(buf, off)
        place = x.hits(h)
        for d in np.unique(np.searchsorted(o, np.flatnonzero(place >= 0), side="right") - 1).tolist():
            for found in x.match(h[o[d]:o[d + 1]], place[o[d]:o[d + 1]], threshold):
                yield (i0 + d, *found)


def _indexes(items: DataFrame, item_id: str, item_text: str, radius: int, block_bytes: int):
    """A broadcast index for every block of items, one at a time."""
    items = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t"))
    n = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]     # one number
    blocks = max(1, -(-n // block_bytes))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()   # about block_bytes
        yield items.sparkSession.sparkContext.broadcast(ItemIndex([r.i for r in mine], [r.t for r in mine], radius))


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                       radius: int = RADIUS, block_bytes: int = 4 << 20) -> DataFrame:
    """Pairs (doc_id, item_id, similarity, first_word, n_words) of documents holding a passage like an item."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(src.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString())

    def one(index) -> DataFrame:
        def run(batches):
            for batch in batches:
                rows = [(batch.column(0)[i].as_py(), index.value.ids[item], score, start, width + SHINGLE - 1)
                        for i, item, score, start, width in _best(index.value, batch.column(1), threshold)]
                if rows:
                    names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

        return src.mapInArrow(run, schema)

    out = reduce(DataFrame.unionByName, map(one, _indexes(items, item_id, item_text, radius, block_bytes)))
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out


def remove_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                        item_text: str = "text", threshold: float = THRESHOLD, radius: int = RADIUS,
                        block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no passage like an item, all columns as they are; no shuffle."""
    at = docs.columns.index(text_col)
    for index in _indexes(items, item_id, item_text, radius, block_bytes):
        def run(batches, index=index):
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[i for i, *_ in _best(index.value, batch.column(at), threshold)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
