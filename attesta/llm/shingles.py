"""Word shingles of many texts at once, their XXH64 hashes and SimHash fingerprints, in numpy."""

from __future__ import annotations

import numpy as np

P1, P2, P3, P4, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
SEED = np.uint64(42)
#: Shingles hashed at once.
AT_ONCE = 200_000


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return x << np.uint64(r) | x >> np.uint64(64 - r)


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64(buffer: bytes, start: np.ndarray, length: np.ndarray, seed: np.uint64 = SEED) -> np.ndarray:
    """XXH64 of buffer[start:start+length] for each pair. The buffer must go on for 8 bytes after the last."""
    bytes_ = np.frombuffer(buffer, dtype=np.uint8)
    words = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
    halves = np.ndarray((len(buffer) - 3,), dtype="<u4", buffer=buffer, strides=(1,))
    with np.errstate(over="ignore"):
        h = np.full(len(start), seed + P5, dtype=np.uint64)
        at, left = start.astype(np.int64), length.astype(np.int64)
        big = np.flatnonzero(left >= 32)
        if len(big):
            v = [np.full(len(big), s, dtype=np.uint64) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            live = np.arange(len(big))
            while len(live):
                pos = at[big[live]]
                for k in range(4):
                    v[k][live] = _round(v[k][live], words[pos + 8 * k])
                at[big[live]] += 32
                left[big[live]] -= 32
                live = live[left[big[live]] >= 32]
            total = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                total = (total ^ _round(np.uint64(0), x)) * P1 + P4
            h[big] = total
        h += length.astype(np.uint64)
        live = np.flatnonzero(left >= 8)
        while len(live):
            h[live] = _rotl(h[live] ^ _round(np.uint64(0), words[at[live]]), 27) * P1 + P4
            at[live] += 8
            left[live] -= 8
            live = live[left[live] >= 8]
        live = np.flatnonzero(left >= 4)
        h[live] = _rotl(h[live] ^ halves[at[live]].astype(np.uint64) * P1, 23) * P2 + P3
        at[live] += 4
        left[live] -= 4
        live = np.flatnonzero(left > 0)
        while len(live):
            h[live] = _rotl(h[live] ^ bytes_[at[live]].astype(np.uint64) * P5, 11) * P1
            at[live] += 1
            left[live] -= 1
            live = live[left[live] > 0]
        h = (h ^ h >> np.uint64(33)) * P2
        h = (h ^ h >> np.uint64(29)) * P3
        return h ^ h >> np.uint64(32)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then runs of anything but space, tab, line feed, vertical tab, form feed and carriage return."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def spans(counts: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the shingles of texts with so many words each, and the shingles of each text (fewer words than a shingle: one)."""
    many = np.maximum(counts - width + 1, 1)
    first = np.cumsum(counts) - counts
    i = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    a = np.repeat(first, many) + i
    return starts[a], ends[a + np.repeat(np.minimum(counts, width), many) - 1], many


def shingle_hashes(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles, text after text, and how many each text has (no words: none)."""
    docs = [words_of(t) for t in texts]
    counts = np.array([len(d) for d in docs], dtype=np.int64)
    has = counts > 0
    if not has.any():
        return np.zeros(0, np.uint64), counts
    joined = b" ".join(b" ".join(d) for d in docs if d)
    buffer = joined + b"\0" * 8
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(joined)]])
    a, b, many = spans(counts[has], starts, ends, width)
    hashes = np.concatenate([xxh64(buffer, a[k : k + AT_ONCE], (b - a)[k : k + AT_ONCE]) for k in range(0, len(a), AT_ONCE)])
    out = np.zeros(len(texts), np.int64)
    out[has] = many
    return hashes, out


def simhash(hashes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Per text, the bits that are set in more than half of its hashes; 0 where there are none."""
    out = np.zeros(len(many), dtype=np.uint64)
    has = np.flatnonzero(many > 0)
    ends = np.cumsum(many)
    k = 0
    while k < len(has):  # whole texts, AT_ONCE shingles or one text at a time
        lo = ends[has[k]] - many[has[k]]
        n = max(1, int(np.searchsorted(ends[has[k:]], lo + AT_ONCE, side="right")))
        of = has[k : k + n]
        bits = np.unpackbits(hashes[lo : ends[of[-1]]].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, ends[of] - many[of] - lo, axis=0, dtype=np.int32)
        out[of] = np.packbits(sums * 2 > many[of, None], axis=1, bitorder="little").view(np.uint64).ravel()
        k += n
    return out


def fingerprints(texts: list[str | None], width: int) -> np.ndarray:
    """SimHash of word shingles, text by text in blocks of bounded size."""
    out, k = [], 0
    while k < len(texts):
        n, chars = 0, 0
        while k + n < len(texts) and (not n or chars + len(texts[k + n] or "") <= 2_000_000):
            chars += len(texts[k + n] or "")
            n += 1
        out.append(simhash(*shingle_hashes(texts[k : k + n], width)))
        k += n
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
