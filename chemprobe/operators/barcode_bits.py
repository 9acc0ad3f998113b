"""All reads of a group against all references of a block, 64 reads to a machine word.

For each place of the reads and each letter, one bit a read tells whether it has that letter there. A pattern's
mismatches at a place are counted for all reads at once, by `and` and `or` of such rows, so nothing is kept for a
pair of a read and a reference that doesn't match, and patterns that nearly all reads share cost no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BARS, SECONDS = ("bar", "rev_bar"), ("sec", "rev_sec")
#: Words of one array of bits; some dozens of them are in use at once.
WORDS = 1 << 15


def within(planes: list[np.ndarray], most: int) -> np.ndarray:
    """Where at most so many of the planes have no bit.

    Neighbours are put together two by two, each part as rows for at most 0, 1, ... planes without a bit.
    """
    if most >= len(planes):
        return np.full_like(planes[0], ~np.uint64(0))
    parts = [[x] for x in planes]
    while len(parts) > 1:
        merged = []
        for a, b in zip(parts[::2], parts[1::2]):
            rows = []
            for t in range(min(most + 1, len(a) + len(b))):
                row = None
                for k in range(max(0, t - len(b)), min(t, len(a)) + 1):
                    if k == len(a):
                        both = b[t - k]
                    elif t - k == len(b):
                        both = a[k]
                    else:
                        both = a[k] & b[t - k]
                    row = both if row is None else row | both
                rows.append(row)
            merged.append(rows)
        parts = merged + ([parts[-1]] if len(parts) % 2 else [])
    return parts[0][most]


class Reads:
    """Stretches of reads, the longest read first; `spans` are the first and last place of each column of stretches."""

    def __init__(self, table: pa.Table, spans: list[tuple[int, int]], letters: bytes):
        self.spans, self.letters, self.seen = spans, np.frombuffer(letters, np.uint8), {}
        length = table.column("n").to_numpy()
        order = np.argsort(-length, kind="stable")
        self.length, self.ids = -length[order].astype(np.int64), table.column("read_id").take(pa.array(order))
        self.words = (len(order) + 63) // 64
        self.text = []
        for i in range(len(spans)):
            x = table.column(f"s{i}").cast(pa.large_string()).combine_chunks()
            x = x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks)
            _, at, data = x.buffers()
            at = np.frombuffer(at, np.int64)[x.offset : x.offset + len(x)]
            self.text.append((np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at[order]))

    def reach(self, place: int) -> int:
        return int(np.searchsorted(self.length, -place, "right"))

    def at(self, place: int) -> np.ndarray:
        """A row of bits for each letter, and one without bits."""
        found = self.seen.get(place)
        if found is None:
            if len(self.seen) > 512:
                self.seen.clear()
            i = next(i for i, (lo, hi) in enumerate(self.spans) if lo <= place <= hi)
            k, (data, start) = self.reach(place), self.text[i]
            bits = np.zeros((len(self.letters) + 1, (k + 63) // 64 * 64), bool)
            bits[:-1, :k] = data[start[:k] + (place - self.spans[i][0])] == self.letters[:, None]
            found = self.seen[place] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        return found

    def hits(self, codes: np.ndarray, start: int, tolerance: int, most: int) -> np.ndarray:
        """For each pattern (a row of letters' numbers), the reads that have it within `tolerance` of its place."""
        out = np.zeros((len(codes), self.words), np.uint64)
        lo, n = max(start - tolerance, 1), codes.shape[1]
        for p in range(lo, max(start + tolerance + 1, lo) + 1):
            k = self.reach(p + n - 1)
            if not k:
                break
            w = (k + 63) // 64
            for at in range(0, len(codes), step := max(1, WORDS // w)):
                some = codes[at : at + step]
                near = within([self.at(p + j)[some[:, j], :w] for j in range(n)], most)
                if k % 64:
                    near[:, -1] &= np.uint64((1 << k % 64) - 1)
                out[at : at + step, :w] |= near
        return out

    def merged(self, bits: np.ndarray) -> None:
        """Rows of one read_id count as one read."""
        if not hasattr(self, "twice"):
            first: dict = {}
            self.twice = [(i, j) for i, x in enumerate(self.ids.to_pylist()) if (j := first.setdefault(x, i)) != i]
        for i, j in self.twice:
            one = bits[:, i >> 6] >> np.uint64(i & 63) & np.uint64(1)
            bits[:, j >> 6] |= one << np.uint64(j & 63)
            bits[:, i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))


def places(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, read) of all bits."""
    row, word = np.nonzero(bits)
    which, bit = np.nonzero(np.unpackbits(bits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[which], word[which] * 64 + bit


def found(reads: Reads, patterns: pa.Table, mismatches: int, tolerance: int, second_tolerance: int) -> Iterator[tuple[pa.Array, dict[str, np.ndarray], np.ndarray]]:
    """(references, kind -> bits of reads, whether a reference has a second signature) for some references at a time."""
    kinds, starts, most = (patterns.column(c).to_pylist() for c in ("kind", "start", "most"))
    texts = [x.encode() for x in patterns.column("pattern").to_pylist()]
    number = {x: i for i, x in enumerate(reads.letters.tolist())}
    refs = patterns.column("ref").combine_chunks().dictionary_encode()
    refs = refs.combine_chunks() if isinstance(refs, pa.ChunkedArray) else refs
    of = refs.indices.to_numpy()
    rows: list[list[int]] = [[] for _ in refs.dictionary]
    for i, r in enumerate(of):
        rows[r].append(i)
    order = sorted(range(len(rows)), key=lambda r: max(starts[i] for i in rows[r]))
    for lo in range(0, len(order), step := max(1, 2 * WORDS // max(reads.words, 1))):
        some = order[lo : lo + step]
        bits = {k: np.zeros((len(some), reads.words), np.uint64) for k in BARS + SECONDS}
        has, alike = np.zeros(len(some), bool), {}
        for k, r in enumerate(some):
            for nth, i in enumerate(rows[r]):
                has[k] |= kinds[i] == "sec"
                # of each reference, one row at most, so that rows can be put into bits at once
                alike.setdefault((kinds[i], starts[i], len(texts[i]), most[i], nth), []).append((k, texts[i]))
        for (kind, start, _, far, _), all_of in sorted(alike.items(), key=lambda x: x[0][1]):
            none = len(number)
            names = number if kind in SECONDS else {x: i for x, i in number.items() if x in b"ACGT"}
            codes = np.array([[names.get(x, none) for x in t] for _, t in all_of])
            first, near = kind in BARS, tolerance if kind in BARS else second_tolerance
            bits[kind][[k for k, _ in all_of]] |= reads.hits(codes, start, near, mismatches if first else far)
        for x in bits.values():
            reads.merged(x)
        yield refs.dictionary.take(pa.array(some)), bits, has
